"""Tables made from nothing: random rectangles and the regular lattice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.operators.clean import TRAIN_BOX
from siteplan.operators.grid import fan_out


def gen_places(
    spark: SparkSession,
    n: int = 100_000,
    box: tuple[float, float, float, float] = TRAIN_BOX,
    min_side: float = 0.5,
    max_side: float = 10.0,
    seed: int = 0,
    tries: int = 256,
    ids: DataFrame | None = None,
) -> DataFrame:
    """n random rectangles in the box with sides from min_side to max_side.

    Each place draws corner pairs until one fits: rows stand on their own, so no counting
    across tasks is needed to end up with n. About 28 % of the draws fit with the default
    sides, so `tries` draws all miss once in 10^36 places; that is an error. All numbers come from the
    md5 of the row id, so a lost task makes the same rows again and other engines can, too.
    `ids` (one column, id) gives the rows instead of n; the id is then kept.
    """
    west, south, east, north = box

    def corner(k: Column, axis: int) -> Column:
        text = F.concat_ws("|", F.col("id").cast("string"), F.lit(str(seed)), k.cast("string"), F.lit(str(axis)))
        u = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
        low, high = (west, east) if axis % 2 == 0 else (south, north)
        return F.lit(low) + F.lit(high - low) * u

    def fits(sides: Column) -> Column:
        w, h = sides["w"], sides["h"]
        return w.between(min_side, max_side) & h.between(min_side, max_side) & (w > 0) & (h > 0)

    def drawn(low: int, high: int) -> Column:
        """The first draw of a batch that fits; its four corners are computed once."""

        def sides(k: Column) -> Column:
            w, h = F.abs(corner(k, 0) - corner(k, 2)), F.abs(corner(k, 1) - corner(k, 3))
            return F.struct(k.alias("k"), w.alias("w"), h.alias("h"))

        return F.get(F.filter(F.transform(F.sequence(F.lit(low), F.lit(high)), sides), fits), F.lit(0))["k"]

    # draw in growing batches: most places fit within the first
    ends = [0, *[e for e in (4, 16, 64) if e < tries], tries]
    none = F.raise_error(F.lit("no rectangle of this size fits the box")).cast("int")
    attempt = F.coalesce(*[drawn(a, b - 1) for a, b in zip(ends, ends[1:])], none)
    k = F.col("k")
    return (
        # a short table of ids may lie in one file; its rows cost much more than its bytes
        (spark.range(n) if ids is None else ids.repartition(fan_out(ids)))
        .withColumn("k", attempt)
        .select(
            *([] if ids is None else ["id"]),
            F.least(corner(k, 0), corner(k, 2)).alias("lon1"),
            F.least(corner(k, 1), corner(k, 3)).alias("lat1"),
            F.greatest(corner(k, 0), corner(k, 2)).alias("lon2"),
            F.greatest(corner(k, 1), corner(k, 3)).alias("lat2"),
        )
    )


def gen_lattice(spark: SparkSession, box: tuple[float, float, float, float] = TRAIN_BOX, step: float = 0.04) -> DataFrame:
    """Lattice points origin + i·step from the lower left corner, the upper ends left out."""
    west, south, east, north = box
    nx, ny = round((east - west) / step), round((north - south) / step)
    i, j = F.expr(f"id div {ny}"), F.col("id") % ny
    return spark.range(nx * ny).select(
        (F.lit(west) + i * F.lit(step)).alias("lon"), (F.lit(south) + j * F.lit(step)).alias("lat")
    )
