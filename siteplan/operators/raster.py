"""Raster tiles to pixel rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiles_to_points(
    tiles: DataFrame,
    box: tuple[float, float, float, float] | None = None,
    anchor: str = "center",
    width: float | None = None,
    names: tuple[str, ...] = ("lon", "lat", "pop_cnt"),
    skip_nan: bool | None = None,
    keep: tuple[str, ...] = (),
    bands: tuple[str, ...] = ("band0",),
) -> DataFrame:
    """Pixel rows (x, y, a value per column of `bands`) of tile rows.

    anchor "center" places a pixel at its cell centre and skips pixels that are NaN
    in all bands; anchor "corner" places
    it at the upper left of its cell, measured over the whole file, and keeps NaN. `width`
    replaces the file's width in degrees for the corner longitude (1.0 is what one-degree
    tiles use). Tiles read with a stride hold every n-th row and column of their file. `box`
    drops whole tiles outside it first (better still, give it to the reader too) and then
    every pixel not strictly inside.
    """
    if anchor not in ("center", "corner"):
        raise ValueError("anchor is center or corner")
    x_name, y_name, *v_names = names
    if len(v_names) != len(bands):
        raise ValueError("names are x, y and one per band")
    if box is not None:
        west, south, east, north = box
        tiles = tiles.where(
            (F.col("xmax") >= west) & (F.col("xmin") <= east) & (F.col("ymax") >= south) & (F.col("ymin") <= north)
        )
    cells = tiles.select("*", F.posexplode(F.arrays_zip(*bands)).alias("pos", "v"))
    cells = cells.withColumns(
        {"col": F.col("pos") % F.col("cols") * F.col("step"), "row": F.expr("pos div cols") * F.col("step")}
    )
    if anchor == "center":
        x = F.col("xmin") + (F.col("col") + 0.5) * ((F.col("file_xmax") - F.col("file_xmin")) / F.col("file_cols"))
        y = F.col("ymax") - (F.col("row") + 0.5) * ((F.col("file_ymax") - F.col("file_ymin")) / F.col("file_rows"))
    else:
        span = F.lit(float(width)) if width is not None else F.col("file_xmax") - F.col("file_xmin")
        x = F.col("file_xmin") + (F.col("col") + F.col("col0")) / F.col("file_cols") * span
        height = F.col("file_ymax") - F.col("file_ymin")
        y = F.col("file_ymax") - (F.col("row") + F.col("row0")) / F.col("file_rows") * height
    if skip_nan if skip_nan is not None else anchor == "center":
        cells = cells.where(reduce(lambda a, b: a | b, [~F.isnan(F.col("v")[b]) for b in bands]))
    values = [F.col("v")[b].alias(name) for b, name in zip(bands, v_names)]
    points = cells.select(*keep, x.alias(x_name), y.alias(y_name), *values)
    if box is not None:
        points = points.where(
            (F.col(x_name) > west) & (F.col(x_name) < east) & (F.col(y_name) > south) & (F.col(y_name) < north)
        )
    return points
