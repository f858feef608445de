"""Grid cells, and equi-joins on cells that stay balanced when cells are crowded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from siteplan.session import kept

# A cell with up to this many rows on the right side needs no count of its left side: every
# left row meets few rows, and Spark's adaptive skew join splits a large left side by size.
CALM_ROWS = 1_000
# A crowded cell is split until no task tests more pairs than this.
HOT_PAIRS = 100_000_000
# A list of split cells up to this length is broadcast (a few MB), a longer one is shuffled.
SMALL_LIST = 100_000
# Cell numbers stay within this range, so that their neighbours' numbers are longs too;
# coordinates beyond it share the outermost cells.
EDGE_CELL = 2**62


def cell_index(coordinate: Column | str, size: float, edge: int = EDGE_CELL) -> Column:
    """Grid index of a coordinate. Monotone, so index order never contradicts coordinate order.

    Coordinates `edge` cells and more from zero share the outermost cells, whose number says
    nothing about their place.
    """
    c = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    cell = F.floor(F.greatest(F.least(c / F.lit(float(size)), F.lit(float(edge))), F.lit(float(-edge))))
    return cell.cast("long")


def located(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows with a position; rows with a NULL or NaN coordinate match no shape."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x)) & ~F.isnan(F.col(y)))


def with_cells(
    df: DataFrame, x: str, y: str, size: float, gx: str = "gx", gy: str = "gy", edge: int = EDGE_CELL
) -> DataFrame:
    return df.withColumns({gx: cell_index(x, size, edge), gy: cell_index(y, size, edge)})


def fan_out(df: DataFrame) -> int:
    """Partitions for a small table whose rows are about to be multiplied.

    A fixed number, because adaptive execution would merge the still small partitions
    and leave the multiplied rows to a few tasks.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def split_plan(left: DataFrame, sizes: DataFrame, on: list[str], hot_pairs: int = HOT_PAIRS) -> DataFrame | None:
    """(keys, parts_l, parts_r): into how many parts each side of a crowded key is cut, by both sides' counts.

    `sizes` counts the right side's rows per key (n_r). None if no key needs it. The list is written to the scratch folder, so it has no bound.
    """
    calm = min(CALM_ROWS, hot_pairs)
    crowded = kept(sizes.where(F.col("n_r") > calm), "crowded-cells")
    if crowded.isEmpty():
        return None
    counts = left.join(crowded, on).groupBy(*on, "n_r").agg(F.count("*").alias("n_l"))
    wanted = F.col("n_l") * (F.col("n_r") / F.lit(float(hot_pairs)))
    # in proportion to the sides, so that the pieces are about square
    parts_r = F.least(F.col("n_r"), F.greatest(F.lit(1), F.ceil(F.sqrt(wanted * F.col("n_r") / F.col("n_l")))))
    parts_l = F.least(F.col("n_l"), F.greatest(F.lit(1), F.ceil(wanted / parts_r)))
    cut = counts.where(wanted > 1).select(*on, parts_l.cast("int").alias("parts_l"), parts_r.cast("int").alias("parts_r"))
    cut = kept(cut, "split-cells")
    return None if cut.isEmpty() else cut


def cell_join(
    left: DataFrame, right: DataFrame, on: list[str], hot_pairs: int = HOT_PAIRS, sizes: DataFrame | None = None
) -> DataFrame:
    """Inner equi-join whose crowded keys are cut into parts on both sides, by the product of their counts.

    Every row of a side goes to one part of its own side and is repeated per part of the
    other. The part is drawn from the row and its input partition, so equal rows spread as
    their input does. The right side's rows per key are counted when the join is built, unless
    `sizes` (keys, n_r) is given; the sides must differ in the names of their other columns.

    The merge hint keeps Spark from broadcasting a side: its size estimates do not see that
    cells were exploded, and a broadcast would leave the work to the other side's few files.
    """
    if sizes is None:
        sizes = right.groupBy(*on).agg(F.count("*").alias("n_r"))
    plan = split_plan(left, sizes, on, hot_pairs)
    if plan is None:
        return left.join(right.hint("merge"), on)
    plan = F.broadcast(plan) if plan.count() <= SMALL_LIST else plan

    def dealt(df: DataFrame, mine: str, other: str) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        placed = df.withColumn("at", F.spark_partition_id()).join(plan, on, "left")
        own = F.pmod(F.xxhash64(*df.columns, "at"), F.coalesce(F.col(mine), F.lit(1))).cast("int")
        return placed.select(*df.columns, own.alias(f"own_{mine}"), each.alias(f"own_{other}"))

    a = dealt(left, "parts_l", "parts_r")
    b = dealt(right, "parts_r", "parts_l")
    both = ["own_parts_l", "own_parts_r"]
    return a.join(b.hint("merge"), [*on, *both]).drop(*both)


def tile_groups(left: DataFrame, right: DataFrame, on: list[str], sizes: DataFrame, tile_rows: int) -> PandasCogroupedOps:
    """Both sides' rows of every key that both hold, as groups to be worked on together.

    `sizes` counts the right side's rows per key (n_r). A key with more rows on a side than
    `tile_rows` is cut into parts, and each part meets all parts of the other side. The groups are
    dealt to `fan_out` tasks: a tile takes far more work than its bytes suggest.
    """
    keys = [*on, "own_l", "own_r"]
    counts = left.groupBy(*on).agg(F.count("*").alias("n_l")).join(sizes, on)
    plan = kept(counts.select(*on, *[F.ceil(F.col(f"n_{s}") / tile_rows).cast("int").alias(f"parts_{s}") for s in "lr"]), "tiles")

    def dealt(df: DataFrame, mine: str, other: str):
        own = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.col(f"parts_{mine}")).cast("int")
        each = F.explode(F.sequence(F.lit(0), F.col(f"parts_{other}") - 1))
        met = df.join(plan, on).select(*df.columns, own.alias(f"own_{mine}"), each.alias(f"own_{other}"))
        return met.repartition(fan_out(left), *keys).groupBy(*keys)

    return dealt(left, "l", "r").cogroup(dealt(right, "r", "l"))


def dyadic(lo: Column, hi: Column, levels: int) -> Column:
    """Cut the index range [lo, hi) into aligned blocks of 1, 2, 4 … 2^levels cells.

    Array of struct<k, i>: block i at level k covers cells i·2^k up to (i+1)·2^k − 1. A
    range of n cells needs about 2·log2(n) blocks instead of n cells.
    """

    def up(k: int) -> Column:  # ceil(lo / 2^k)
        return F.negative(F.shiftright(F.negative(lo), k))

    def down(k: int) -> Column:  # floor(hi / 2^k)
        return F.shiftright(hi, k)

    def block(k: int, i: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), i.cast("long").alias("i"))

    pieces = []
    for k in range(levels):
        a, b = up(k), down(k)
        pieces.append(F.when((a < b) & (a % 2 != 0), block(k, a)))
        pieces.append(F.when((a < b) & (b % 2 != 0), block(k, b - 1)))
    a, b = up(levels), down(levels)
    top = F.when(a < b, F.transform(F.sequence(a, b - 1), lambda i: block(levels, i))).otherwise(
        F.array().cast("array<struct<k:int,i:bigint>>")
    )
    return F.concat(F.array_compact(F.array(*pieces)), top)


def cell_blocks(cells: DataFrame, levels: int, merged: list[Column]) -> DataFrame:
    """Aggregate per-cell partials into every block dyadic() can ask for."""
    return (
        cells.withColumn("kx", F.explode(F.sequence(F.lit(0), F.lit(levels))))
        .withColumn("ky", F.explode(F.sequence(F.lit(0), F.lit(levels))))
        .withColumn("ix", F.expr("shiftright(gx, kx)"))
        .withColumn("iy", F.expr("shiftright(gy, ky)"))
        .groupBy("kx", "ky", "ix", "iy")
        .agg(*merged)
    )
