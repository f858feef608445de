"""Greedy site placement: best point first, each pick lowering the scores around it.

Scores only ever fall, so a point that beats every point within the radius (higher score,
then smaller order key) is picked before any of them, at the score it has now. Whole
batches of such points can therefore be picked at once, in any place of the map, with the
same outcome as picking one by one. Each round:

1. every tile keeps its best TOP rows; the next best row stands for all rows left out,
2. each tile, seeing its neighbours' rows in reach, picks as long as some row of its own
   beats all rows in reach and all left-out rows around it,
3. the new picks lower the scores of all points within the radius. Only the tiles they
   reach are written again, as the change table of the round; all others stay where they
   were last written.

Once n picks are known, points that cannot reach the n-th one are dropped; the rounds end
when none is left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteplan.functions.geo import dist
from siteplan.functions.scoring import DECAY_K, decay_penalty
from siteplan.operators.grid import cell_index, located
from siteplan.session import scratch_dir

TOP = 512
# Tiles are this many radii wide. Their grid moves from round to round, so that a chain of
# picks held up at a tile border lies inside a tile in another round.
TILE_RADII = 4
SHIFTS = ((0.0, 0.0), (0.5, 0.5), (0.5, 0.0), (0.0, 0.5))
SALTS = 32
PICKS_PER_ROUND = 512


def argmax_row(df: DataFrame, score: str, order: list[str]) -> DataFrame:
    """The row with the highest score; ties go to the smallest order key."""
    best = df.agg(F.min(F.struct((-F.col(score)).alias("_neg"), *order, F.struct(*df.columns).alias("_row"))).alias("b"))
    return best.where(F.col("b").isNotNull()).select("b._row.*")


def _pick_tile(pdf: pd.DataFrame, order: list[str], radius: float, k: float) -> pd.DataFrame:
    """Picks of one tile from its own rows (role 0), rows in reach (1) and left-out rows' bounds (2)."""
    pdf = pdf.sort_values([*order, "id"], kind="stable").reset_index(drop=True)
    role = pdf["role"].to_numpy()
    x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
    score = pdf["score"].to_numpy(float).copy()
    own = np.flatnonzero(role == 0)
    picked, at = [], []
    if len(own):
        dx, dy = x[own, None] - x[None, :], y[own, None] - y[None, :]
        d = np.sqrt(dx * dx + dy * dy)
        # bounds of left-out rows have no position of their own: they reach everything
        reach = (d < radius) | (role == 2)[None, :]
        seen = role < 2
        while len(picked) < PICKS_PER_ROUND:
            rank = np.empty(len(pdf), dtype=np.int64)
            rank[np.lexsort((np.arange(len(pdf)), -score))] = np.arange(len(pdf))
            first = np.where(reach, rank[None, :], len(pdf)).min(axis=1)
            safe = np.flatnonzero(first == rank[own])
            if not len(safe):
                break
            for i in safe[np.argsort(rank[own[safe]])]:
                picked.append(own[i])
                at.append(score[own[i]])
            # safe rows are out of reach of each other, so their penalties do not mix up
            for i in safe[np.argsort(rank[own[safe]])]:
                hit = seen & (d[i] < radius)
                score[hit] -= k / (d[i][hit] * d[i][hit] + k)
    out = pdf.loc[picked, [*order, "id", "x", "y"]].copy()
    out["score"] = at
    return out


def _before(cols: list[str], bound) -> Column:
    """Whether the row's (−score, order, id) comes before the bound row's."""
    test = F.lit(False)
    for c in reversed(cols):
        value = F.lit(bound[c])
        test = (F.col(c) < value) | ((F.col(c) == value) & test)
    return test


def greedy_place(
    df: DataFrame,
    n: int = 1000,
    radius: float = 0.4,
    k: float = DECAY_K,
    order: tuple[str, ...] = ("lon", "lat"),
    xy: tuple[str, str] = ("lon", "lat"),
    score: str = "score",
    top: int = TOP,
) -> DataFrame:
    """The n picks (pick, lon, lat, score) in pick order, `pick` counting from 1.

    Equal scores go by the `order` columns. A site may be picked again once its score, one
    lower after each pick, is the highest once more. State is kept in the shared scratch
    folder, a change table per round, so a lost executor costs no more than the current round.
    """
    spark = df.sparkSession
    base = scratch_dir(spark, "placement")
    order = list(order)
    x, y = xy
    side = TILE_RADII * radius
    keys = [f"o{i}" for i in range(len(order))]
    start = located(df, x, y).where(F.col(score).isNotNull() & ~F.isnan(score))
    first = start.select(
        *[F.col(c).alias(o) for c, o in zip(order, keys)],
        F.monotonically_increasing_id().alias("id"),
        F.col(x).cast("double").alias("x"),
        F.col(y).cast("double").alias("y"),
        F.col(score).cast("double").alias("score"),
    )
    state = _State(spark, f"{base}/state", first.schema, side)
    state.restart(first)
    pick_schema = first.schema
    picks_at: list[str] = []
    sequence = [(-F.col("score")).alias("neg"), *keys, "id"]
    neg = ["neg", *keys, "id"]
    bound = None

    def best_picks(paths: list[str]) -> DataFrame:
        known = spark.read.schema(pick_schema).parquet(*paths)
        return known.withColumn("neg", -F.col("score")).orderBy(*neg).limit(n)

    def within(rows: DataFrame) -> DataFrame:
        """Rows that can still be among the n picks."""
        if bound is None:
            return rows
        reach = rows.where(F.col("score") >= F.lit(-bound["neg"]))  # one the scan can push down
        return reach.withColumn("neg", -F.col("score")).where(_before(neg, bound)).drop("neg")

    step = 0
    while True:
        live = within(state.read())
        new_at = f"{base}/picks-{step}"
        _round_picks(live, keys, radius, k, side, SHIFTS[step % len(SHIFTS)], top, pick_schema).write.parquet(new_at)
        new = spark.read.schema(pick_schema).parquet(new_at)
        picks_at.append(new_at)
        # one row to the driver: how many picks are known and where the n-th stands
        last = best_picks(picks_at).agg(F.count("*").alias("n"), F.max(F.struct(*neg)).alias("last")).first()
        if last["n"] == 0:
            break
        fresh = new.withColumn("neg", -F.col("score"))
        if last["n"] >= n:
            bound = last["last"]
            fresh = fresh.where(_before(neg, bound) | F.col("id").eqNullSafe(F.lit(bound["id"])))
        reached = _reached(fresh, radius, side, neg)
        state.change(within, reached.select("gx", "gy"), lambda rows: _apply(rows, reached, radius, k))
        step += 1
        if within(state.read()).isEmpty():
            break

    result = best_picks(picks_at)
    # n rows at most: numbering them in one task is bounded by the parameter
    numbered = result.withColumn("pick", F.row_number().over(Window.orderBy(*neg)))
    return numbered.select("pick", F.col("x").alias(x), F.col("y").alias(y), F.col("score").alias(score))


class _State:
    """The points by tile. A tile's rows are those of the last step that wrote it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, side: float):
        self.spark, self.path, self.columns, self.side = spark, path, schema.names, side
        self.schema = T.StructType([*schema, T.StructField("gx", T.LongType()), T.StructField("gy", T.LongType())])
        self.base, self.step, self.rows, self.changed = 0, -1, 0, 0

    def _write(self, rows: DataFrame) -> int:
        self.step += 1
        at = f"{self.path}/step={self.step}"
        rows.select(*self.columns, F.col("gx").cast("long"), F.col("gy").cast("long")).write.parquet(at)
        return self.spark.read.schema(self.schema).parquet(at).count()

    def restart(self, rows: DataFrame) -> None:
        """Write all rows as the table that later changes refer to."""
        self.rows = self._write(rows.withColumns({"gx": cell_index("x", self.side), "gy": cell_index("y", self.side)}))
        self.base, self.changed = self.step, 0

    def read(self) -> DataFrame:
        """The rows as they are now, with their tile."""
        every = T.StructType([*self.schema, T.StructField("step", T.IntegerType())])
        rows = self.spark.read.schema(every).parquet(self.path).where(F.col("step") >= self.base)
        if self.step == self.base:
            return rows.drop("step")
        # one row per tile written since; tables of the tiles themselves, so no data is read for it
        last = self.spark.read.schema("gx long, gy long, step int").parquet(f"{self.path}-tiles").where(F.col("step") > self.base)
        last = last.groupBy("gx", "gy").agg(F.max("step").alias("last"))
        rows = rows.join(last, ["gx", "gy"], "left")
        return rows.where(F.col("step") == F.coalesce("last", F.lit(self.base))).drop("step", "last")

    def change(self, keep, tiles: DataFrame, lower) -> None:
        """Write the rows of `tiles` as `lower` makes them, less those that `keep` leaves out.

        Once the change tables hold more rows than the base, all is written as a new base:
        what is read in a round stays within twice the rows, what is written within twice
        the changes.
        """
        now = self.read()
        if self.changed > self.rows:
            rest = now.join(tiles, ["gx", "gy"], "left_anti")
            self.rows = self._write(keep(rest.unionByName(lower(now))))
            self.base, self.changed = self.step, 0
        else:
            # a tile all of whose rows fall out must be known as written, too
            tiles.write.parquet(f"{self.path}-tiles/step={self.step + 1}")
            self.changed += self._write(keep(lower(now)))


def _round_picks(
    state: DataFrame,
    keys: list[str],
    radius: float,
    k: float,
    side: float,
    shift: tuple[float, float],
    top: int,
    pick_schema: T.StructType,
) -> DataFrame:
    def tile(c: Column, axis: int) -> Column:
        return cell_index(c + F.lit(shift[axis] * side), side)

    state = state.withColumns({"gx": tile(F.col("x"), 0), "gy": tile(F.col("y"), 1)})
    ranking = [F.desc("score"), *keys, "id"]
    # two steps, so that a crowded tile is thinned out by several tasks first
    salted = state.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    thin = salted.withColumn("rn", F.row_number().over(Window.partitionBy("gx", "gy", "salt").orderBy(*ranking)))
    thin = thin.where(F.col("rn") <= top + 1)
    best = thin.withColumn("rn", F.row_number().over(Window.partitionBy("gx", "gy").orderBy(*ranking)))
    best = best.where(F.col("rn") <= top + 1).drop("salt")
    bound = F.col("rn") > top
    # rows go to the tiles within reach of them, the left-out rows' bound to all tiles around
    margin = radius * 1e-9 + 1e-12

    def tiles(c: str, g: str, axis: int) -> Column:
        reach = F.lit(radius + margin)
        near = F.sequence(tile(F.col(c) - reach, axis), tile(F.col(c) + reach, axis))
        around = F.sequence(F.col(g) - 1, F.col(g) + 1)
        return F.explode(F.when(bound, around).otherwise(near))

    sent = best.withColumn("tx", tiles("x", "gx", 0)).withColumn("ty", tiles("y", "gy", 1))
    home = (F.col("tx") == F.col("gx")) & (F.col("ty") == F.col("gy"))
    sent = sent.withColumn("role", F.when(bound, 2).when(home, 0).otherwise(1))
    picks = sent.groupBy("tx", "ty").applyInPandas(lambda pdf: _pick_tile(pdf, keys, radius, k), pick_schema)
    return picks


def _reached(picks: DataFrame, radius: float, side: float, neg: list[str]) -> DataFrame:
    """The tiles in reach of picks, each with its picks in pick order."""
    margin = radius * 1e-9 + 1e-12
    reach = F.lit(radius + margin)
    return (
        picks.withColumn("gx", F.explode(F.sequence(cell_index(F.col("x") - reach, side), cell_index(F.col("x") + reach, side))))
        .withColumn("gy", F.explode(F.sequence(cell_index(F.col("y") - reach, side), cell_index(F.col("y") + reach, side))))
        .groupBy("gx", "gy")
        # bounded: the tiles around made at most PICKS_PER_ROUND picks each
        .agg(F.array_sort(F.collect_list(F.struct(*neg, F.col("x").alias("px"), F.col("y").alias("py")))).alias("near"))
    )


def _apply(live: DataFrame, reached: DataFrame, radius: float, k: float) -> DataFrame:
    """The points of the tiles that picks reach, after their penalties, taken off in pick order."""
    joined = live.join(reached, ["gx", "gy"])

    def lower(s: Column, p: Column) -> Column:
        d = dist("x", "y", p["px"], p["py"])
        return F.when(d < radius, s - decay_penalty(d, k)).otherwise(s)

    return joined.withColumn("score", F.aggregate("near", F.col("score"), lower)).drop("near")
