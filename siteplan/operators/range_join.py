"""Aggregate points per rectangle without a nested loop.

A rectangle is split into inner grid cells, which lie wholly inside it and are answered
from pre-aggregated blocks of cells, and border cells, whose points are tested one by
one. Cell indexes are monotone in the coordinate, so an inner cell can hold no point on
or outside a bound: the result is exact for strict and for inclusive bounds. By default
the cells follow the points: both axes are cut at their quantiles.

Counts and decimal sums take wide cells (tiles): the points of a tile and the rectangles whose
outline runs through it meet in one group, which adds up in n·log n (`tile_sums`). A
rectangle so has few border cells, however many points there are.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteplan.functions.geo import rect_to_wkt
from siteplan.operators.aggregates import Agg, Partials
from siteplan.operators.attach import attach
from siteplan.operators.grid import HOT_PAIRS, cell_blocks, cell_index, cell_join, dyadic, fan_out, located, tile_groups
from siteplan.operators.tile_sums import rectangle_sums
from siteplan.session import kept

BOUNDS = ("lon1", "lat1", "lon2", "lat2")
# Block levels of a narrow map; a wider one gets one more per doubling.
LEVELS = 4
# With a fixed cell side, cells are numbered up to here on both sides of zero, so that outlines
# stay short where a few points lie far out. Those share the outermost cells and are tested one
# by one: none is lost.
FAR_CELL = 2**16
# Where both axes are cut: at quarters of the points, and near the ends, so that a few points
# far out widen no cell of the others. More cuts would cost more per point than they save.
SHARES = (0.001, 0.01, 0.25, 0.5, 0.75, 0.99, 0.999)
# Points of a cell, about, and the most cells between two cuts.
CELL_POINTS, MOST_PER_CUT = 16, 256
# Points of a tile, about, and the most points or rectangles that meet in one group.
TILE_POINTS, TILE_ROWS = 2**17, 2**18


@dataclass(frozen=True)
class Grid:
    """Cells of a plane: `per` equal ones between neighbouring cuts of an axis, one beyond either end."""

    x: tuple[float, ...]
    y: tuple[float, ...]
    per: int

    def index(self, axis: int, c: Column) -> Column:
        """The cell of a coordinate; monotone, as cuts ascend and each piece is filled up to its own last cell.

        The piece is found first and bound, so that the cell's formula stands in the plan once.
        """
        cuts = self.y if axis else self.x
        if not cuts:
            return F.lit(0).cast("long")
        piece = F.when(c < F.lit(cuts[0]), -1)
        for k, high in enumerate(cuts[1:]):
            piece = piece.when(c < F.lit(high), k)
        last = len(cuts) - 1
        halves = [(low / 2, high / 2) for low, high in zip(cuts, cuts[1:])] or [(0.0, 1.0)]  # no width overflows
        lows = F.array(*[F.lit(low) for low, _ in halves])
        cells = F.array(*[F.lit(self.per / max(high - low, 5e-324)) for low, high in halves])

        def cell(k: Column) -> Column:
            own = F.least(F.floor((c / 2 - F.get(lows, k)) * F.get(cells, k)), F.lit(self.per - 1))
            return F.when(k < 0, F.lit(-1)).when(k >= last, F.lit(last * self.per)).otherwise(k * self.per + own)

        return F.get(F.transform(F.array(piece.otherwise(last)), cell), 0).cast("long")


def data_grid(pts: DataFrame, xy: tuple[str, str], points: int = CELL_POINTS) -> Grid:
    """A grid that follows the points, about `points` to a cell: cuts at their quantiles, found by a sketch in one pass."""
    finite = [F.when(F.abs(c) < F.lit(float("inf")), c.cast("double")) for c in map(F.col, xy)]
    sketches = [F.percentile_approx(c, list(SHARES), 1000).alias(n) for c, n in zip(finite, "xy")]
    found = located(pts, *xy).agg(F.count("*").alias("n"), *sketches).first()
    cuts = [tuple(sorted(set(found[n] or ()))) for n in "xy"]
    # four pieces hold nearly all points, fewer where many points share a coordinate
    pieces = min(4, *[max(1, len(c) - 1) for c in cuts])
    per = min(MOST_PER_CUT, max(1, round(math.sqrt(found["n"] / points) / pieces)))
    return Grid(*cuts, per)


def _index(cell: float | Grid, axis: int, c: Column) -> Column:
    return cell.index(axis, c) if isinstance(cell, Grid) else cell_index(c, cell, FAR_CELL)


def _placed(pts: DataFrame, xy: tuple[str, str], cell: float | Grid) -> DataFrame:
    return located(pts, *xy).withColumns({"gx": _index(cell, 0, F.col(xy[0])), "gy": _index(cell, 1, F.col(xy[1]))})


def cell_partials(pts: DataFrame, xy: tuple[str, str], aggs: dict[str, Agg], cell: float | Grid) -> DataFrame:
    """One row of partials per occupied grid cell; write it out to reuse it over several joins."""
    parts = Partials(aggs)
    cells = _placed(pts, xy, cell).select("gx", "gy", *parts.of_rows(pts))
    found = cells.groupBy("gx", "gy").agg(*parts.merged(), F.count("*").alias("n_rows"))
    # the grid goes with the table, also into files
    return found.withMetadata("gx", {"grid": asdict(cell) if isinstance(cell, Grid) else {"side": float(cell)}})


def _grid_of(cells: DataFrame) -> float | Grid:
    """The grid that a `cell_partials` table was made with."""
    made = cells.schema["gx"].metadata.get("grid")
    if made is None:
        raise ValueError("stored cells need the grid they were made with")
    return made["side"] if "side" in made else Grid(tuple(made["x"]), tuple(made["y"]), made["per"])


def _border_cells(rects: DataFrame) -> DataFrame:
    """The cells that hold a piece of a rectangle's outline."""
    sides = rects.withColumn("gx", F.explode(F.array_distinct(F.array("gx1", "gx2")))).withColumn(
        "gy", F.explode(F.sequence("gy1", "gy2"))
    )
    caps = (
        rects.where(F.col("gx2") - F.col("gx1") >= 2)
        .withColumn("gx", F.explode(F.sequence(F.col("gx1") + 1, F.col("gx2") - 1)))
        .withColumn("gy", F.explode(F.array_distinct(F.array("gy1", "gy2"))))
    )
    return sides.unionByName(caps)


def _outlines(rects: DataFrame, bounds: tuple[str, str, str, str], cell: float | Grid, edges: tuple[int, ...]) -> DataFrame:
    """Distinct rectangles with the cells of their corners, none farther out than one beyond the occupied `edges`."""
    x1, y1, x2, y2 = bounds
    low_x, high_x, low_y, high_y = edges
    shapes = (
        located(located(rects.select(*bounds), x1, y1), x2, y2)
        .where((F.col(x1) <= F.col(x2)) & (F.col(y1) <= F.col(y2)))
        .distinct()
        .repartition(fan_out(rects), *bounds)
    )
    shapes = shapes.select(
        *bounds,
        F.greatest(_index(cell, 0, F.col(x1)), F.lit(low_x - 1)).alias("gx1"),
        F.greatest(_index(cell, 1, F.col(y1)), F.lit(low_y - 1)).alias("gy1"),
        F.least(_index(cell, 0, F.col(x2)), F.lit(high_x + 1)).alias("gx2"),
        F.least(_index(cell, 1, F.col(y2)), F.lit(high_y + 1)).alias("gy2"),
    )
    return shapes.where((F.col("gx1") <= F.col("gx2")) & (F.col("gy1") <= F.col("gy2")))


def _tested(outlines: DataFrame, rows: DataFrame, sizes: DataFrame, bounds, parts: Partials, strict: bool, hot_pairs: int) -> DataFrame:
    """Partials of the points in the border cells, tested one by one."""
    x1, y1, x2, y2 = map(F.col, bounds)
    px, py = F.col("pt_x"), F.col("pt_y")
    inside = (px > x1) & (px < x2) & (py > y1) & (py < y2) if strict else px.between(x1, x2) & py.between(y1, y2)
    pairs = cell_join(outlines, rows, ["gx", "gy"], hot_pairs, sizes).where(inside)
    return pairs.groupBy(*bounds).agg(*parts.merged())


def _tile_sums(outlines: DataFrame, rows: DataFrame, sizes: DataFrame, bounds, parts: Partials, strict: bool, tile_rows: int) -> DataFrame:
    """Partials of the points in the border tiles: per tile one group of its points and its rectangles.

    A tile with more rows on a side than `tile_rows` is cut into parts, and each part meets all parts of the other side.
    """
    names = list(parts.names)
    kinds = [f"`{b}` double" for b in bounds] + [f"{p} {rows.schema[p].dataType.simpleString()}" for p in names]
    both = tile_groups(outlines, rows, ["gx", "gy"], sizes, tile_rows)
    return both.applyInArrow(lambda a, b: rectangle_sums(b, a, ("pt_x", "pt_y"), tuple(bounds), names, strict), ", ".join(kinds))


def range_join(
    rects: DataFrame,
    pts: DataFrame,
    xy: tuple[str, str],
    aggs: dict[str, Agg],
    strict: bool = True,
    how: str = "left",
    cell: float | Grid | None = None,
    bounds: tuple[str, str, str, str] = BOUNDS,
    cells: DataFrame | None = None,
    hot_pairs: int = HOT_PAIRS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """`rects` with the aggregates of the points inside each rectangle.

    `how="left"` keeps rectangles without points (counts 0, other aggregates NULL),
    `how="inner"` drops them. The grid follows the points (`data_grid`, one more pass over
    the positions) unless `cell` gives one, or the side of square cells: smaller cells leave
    fewer points to test but give each rectangle more border cells (about perimeter / side).
    A bound may lie anywhere, at infinity too: cells are listed only where points are.
    The cells are written to the scratch folder when called, unless given.
    `cells` takes a stored `cell_partials` table of the same points and aggregates; it knows its grid.
    Without `cell` and `cells`, counts and decimal sums go by tiles; a tile of more than
    `tile_rows` points or rectangles is cut into parts.
    """
    x, y = xy
    parts = Partials(aggs)
    tiled = cell is None and cells is None and parts.exact
    if cell is None:
        cell = _grid_of(cells) if cells is not None else data_grid(pts, xy, TILE_POINTS if tiled else CELL_POINTS)
    x1, y1, x2, y2 = bounds
    cells = kept(cell_partials(pts, xy, aggs, cell), "cells") if cells is None else cells
    edges = tuple(edge or 0 for edge in cells.agg(*[f(g) for g in ("gx", "gy") for f in (F.min, F.max)]).first())
    shapes = kept(_outlines(rects, bounds, cell, edges), "outlines")  # read for the inside and for the border
    span = max(edges[1] - edges[0], edges[3] - edges[2])
    levels = max(LEVELS, span.bit_length() - 4)
    blocks = cell_blocks(cells, levels, parts.merged())
    inner = (
        shapes.where((F.col("gx2") - F.col("gx1") >= 2) & (F.col("gy2") - F.col("gy1") >= 2))
        .withColumn("bx", F.explode(dyadic(F.col("gx1") + 1, F.col("gx2"), levels)))
        .withColumn("by", F.explode(dyadic(F.col("gy1") + 1, F.col("gy2"), levels)))
        .select(
            *bounds,
            F.col("bx.k").alias("kx"),
            F.col("by.k").alias("ky"),
            F.col("bx.i").alias("ix"),
            F.col("by.i").alias("iy"),
        )
        .join(blocks.hint("merge"), ["kx", "ky", "ix", "iy"])
        .select(*bounds, *parts.names)
    )

    rows = _placed(pts, xy, cell).select(
        "gx", "gy", F.col(x).alias("pt_x"), F.col(y).alias("pt_y"), *parts.of_rows(pts)
    )
    outlines = _border_cells(shapes).select(*bounds, "gx", "gy")
    sizes = cells.select("gx", "gy", F.col("n_rows").alias("n_r"))
    if tiled:
        rows = rows.withColumns({p: F.col(p).cast(cells.schema[p].dataType) for p in parts.names})
        border = _tile_sums(outlines, rows, sizes, bounds, parts, strict, tile_rows)
    else:
        border = _tested(outlines, rows, sizes, bounds, parts, strict, hot_pairs)

    merged = inner.unionByName(border).groupBy(*bounds).agg(*parts.merged())
    found = merged.select(*bounds, *[parts.final(n).alias(n) for n in aggs])
    joined = attach(rects, found, list(bounds), how).select(*rects.columns, *aggs)
    if how == "left":
        joined = joined.na.fill(0, [n for n, a in aggs.items() if a.kind == "count"])
    return joined


def range_join_wkt(rects: DataFrame, pts: DataFrame, xy: tuple[str, str], aggs: dict[str, Agg], **options) -> DataFrame:
    """Inner range join whose result names each rectangle by its WKT instead of its corners."""
    found = range_join(rects, pts, xy, aggs, how="inner", **options)
    rest = [c for c in found.columns if c not in BOUNDS]
    return found.select(rect_to_wkt(*BOUNDS).alias("rectangle"), *rest)
