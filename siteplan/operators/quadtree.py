"""Disks covered by the cells of a quadtree whose depth follows the data.

The top cells are half a radius wide. A cell is cut into four only where it holds more than
`crowd` rows, and a disk looks into the quarters only where a single row may count: along
its circles. What lies wholly inside is answered from the largest cells, one row each; a
cell of few rows is tested row by row as it is. Sparse data so needs about 20 cells a disk
and dense data no more tests than a thin strip along each circle holds.

Cell distances carry a margin that grows with the coordinate, so rounding can only send a
cell to the exact test, however far from zero the points lie.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.operators.grid import EDGE_CELL, cell_index, fan_out, located, with_cells
from siteplan.session import kept

# A cell with up to this many rows is not cut: a cell of a disk costs about as much as testing
# 50 rows, and four quarters save half the tests.
CROWD = 256
# Cells narrower than this share of the smallest radius would save few more tests.
FINEST = 1 / 16
# From so many cells on a cell is narrower than the gaps between doubles: its distances say nothing.
BLURRED_CELL = 2.0**53


@dataclass(frozen=True)
class Quadtree:
    """`cells` (k, gx, gy, partials, n_r) of every level k, 0 the widest; `rows` by the leaf cell that holds them."""

    size: float
    levels: int
    crowd: int
    cells: DataFrame
    rows: DataFrame

    def sizes(self) -> DataFrame:
        return self.cells.select("k", "gx", "gy", "n_r")


def grow(
    others: DataFrame,
    xy: tuple[str, str],
    radii: tuple[float, ...],
    columns: list[Column],
    merged: list[Column],
    crowd: int = CROWD,
) -> Quadtree:
    """The tree of the rows with a position. `columns` are kept per row, `merged` aggregates them, and itself, per cell.

    The number of levels follows from the fullest top cell. The cells are written to the
    scratch folder when called.
    """
    size = max(radii) / 2
    base = located(others, *xy)
    place = [F.col(xy[0]).alias("nb_x"), F.col(xy[1]).alias("nb_y")]
    n_rows = F.count("*").alias("n_r")

    def rows_in(level: int) -> DataFrame:
        return with_cells(base, *xy, size / 2**level).select("gx", "gy", *place, *columns)

    top = kept(rows_in(0).groupBy("gx", "gy").agg(*merged, n_rows), "cells")
    fullest = top.agg(F.max("n_r")).first()[0] or 0
    useful = math.ceil(math.log2(max(1.0, size / (min(radii) * FINEST))))
    levels = 0 if fullest <= crowd else min(useful, math.ceil(math.log(fullest / crowd, 4)) + 1)
    if not levels:
        level = F.lit(0).alias("k")
        return Quadtree(size, 0, crowd, top.select(level, "*"), rows_in(0).select(level, "*"))

    fine = kept(rows_in(levels).groupBy("gx", "gy").agg(*merged, n_rows), "fine-cells")
    above = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    up = {f"u{a}": F.expr(f"shiftright(g{a}, {levels} - k)") for a in "xy"}
    every = fine.withColumn("k", above).withColumns(up).drop("gx", "gy").withColumnsRenamed({"ux": "gx", "uy": "gy"})
    cells = kept(every.groupBy("k", "gx", "gy").agg(*merged, F.sum("n_r").alias("n_r")), "tree-cells")
    counts = cells.select("k", F.col("gx").alias("ux"), F.col("gy").alias("uy"), F.col("n_r").alias("n_u"))
    calm = F.min(F.when(F.col("n_u") <= crowd, F.col("k")))
    leaves = (
        fine.select("gx", "gy", above.alias("k"))
        .withColumns(up)
        .join(counts, ["k", "ux", "uy"])
        .groupBy("gx", "gy")
        .agg(F.coalesce(calm, F.lit(levels)).alias("k"))
    )
    own = rows_in(levels)
    rest = [c for c in own.columns if c not in ("gx", "gy")]
    rows = own.join(leaves, ["gx", "gy"]).withColumns(up).select("k", F.col("ux").alias("gx"), F.col("uy").alias("gy"), *rest)
    return Quadtree(size, levels, crowd, cells, rows)


def _axis(c: Column, cells: Column, size: float) -> Column:
    """A row per cell of one axis, with its nearest and farthest offset from `c`.

    Exploding structs keeps these values as columns; as plain projections Catalyst would
    copy their formulas into every comparison.
    """
    far_out = F.abs(c) >= F.lit(size * BLURRED_CELL)
    slack = F.when(far_out, F.lit(float("inf"))).otherwise(F.abs(c) * F.lit(2.0**-50))

    def offsets(g: Column) -> Column:
        low, high = g * F.lit(size) - c, (g + 1) * F.lit(size) - c
        return F.struct(
            g.alias("g"),
            F.greatest(low - slack, -high - slack, F.lit(0.0)).alias("near"),
            (F.greatest(F.abs(low), F.abs(high)) + slack).alias("far"),
        )

    return F.explode(F.transform(cells, offsets))


def _reached(strips: DataFrame, r: float, columns: list[str]) -> DataFrame:
    """The cells of both axes' strips that the disk may reach, with their nearest and farthest distance."""
    margin = r * 1e-9 + 1e-12

    def length(part: str) -> Column:
        a, b = F.col(f"sx.{part}"), F.col(f"sy.{part}")
        return F.sqrt(a * a + b * b)

    placed = strips.select(
        *columns,
        F.col("sx.g").alias("gx"),
        F.col("sy.g").alias("gy"),
        (length("near") - margin).alias("near"),
        (length("far") + margin).alias("far"),
    )
    return placed.where(F.col("near") < r)


def disk_cells(
    points: DataFrame, xy: tuple[str, str], r: float, size: float, keep: tuple[str, ...] = (), edge: int = EDGE_CELL
) -> DataFrame:
    """Distinct points with every cell that may hold a neighbour, and that cell's nearest and farthest distance."""
    reach = F.lit(r + r * 1e-9 + 1e-12)

    def strip(c: Column) -> Column:
        return _axis(c, F.sequence(cell_index(c - reach, size, edge), cell_index(c + reach, size, edge)), size)

    base = located(points.select(*xy, *keep), *xy).distinct().repartition(fan_out(points), *xy)
    return _reached(base.withColumn("sx", strip(F.col(xy[0]))).withColumn("sy", strip(F.col(xy[1]))), r, [*xy, *keep])


def _quarters(cells: DataFrame, xy: tuple[str, str], r: float, size: float, columns: list[str]) -> DataFrame:
    def halves(c: str, g: str) -> Column:
        return _axis(F.col(c), F.transform(F.array(F.lit(0), F.lit(1)), lambda d: F.col(g) * 2 + d), size)

    return _reached(cells.withColumn("sx", halves(xy[0], "gx")).withColumn("sy", halves(xy[1], "gy")), r, columns)


def walk(
    tree: Quadtree,
    points: DataFrame,
    xy: tuple[str, str],
    r: float,
    test: Column,
    keep: tuple[str, ...] = (),
    derive: dict[str, Column] | None = None,
    bounded: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(whole, tested): the cells each disk takes as one, and those (k, gx, gy) whose rows are tested.

    `test` says of a disk's cell (near, far, the tree's partials, `derive`) that it cannot be
    taken as one. With `bounded` it may name `bound`, the least distance within which the
    occupied cells alone prove a row. Cells without rows are dropped. Every level is written
    to the scratch folder, unless there is one only.
    """
    carried = [*xy, *keep]
    cover = disk_cells(points, xy, r, tree.size, keep, EDGE_CELL >> tree.levels)
    whole, tested = [], []
    for k in range(tree.levels + 1):
        level = tree.cells.where(F.col("k") == k).drop("k")
        seen = cover.join(level.hint("merge"), ["gx", "gy"])
        if bounded:
            bound = F.min("far").over(Window.partitionBy(*xy))
            seen = seen.withColumn("bound", F.least(bound, F.col("bound")) if k else bound)
        seen = seen.withColumns(derive or {}).withColumn("open", test)
        seen = kept(seen, "cover") if tree.levels else seen
        whole.append(seen.where(~F.col("open")))
        cut = seen.where("open")
        calm = cut if k == tree.levels else cut.where(F.col("n_r") <= tree.crowd)
        tested.append(calm.select(*carried, F.lit(k).alias("k"), "gx", "gy"))
        if k == tree.levels:
            break
        crowded = cut.where(F.col("n_r") > tree.crowd)
        if crowded.isEmpty():
            break
        cover = _quarters(crowded, xy, r, tree.size / 2 ** (k + 1), [*carried, *(["bound"] if bounded else [])])
    return _all(whole), _all(tested)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
