"""Makes the raster files that queries and tests read back; input data, not part of the reader."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

from siteplan.sources.geotiff import FIELD_TYPES


def encode_geotiff(
    values: np.ndarray, xmin: float, ymax: float, dx: float, dy: float, rows_per_strip: int = 16, deflate: bool = False,
    bands: int = 1,
) -> bytes:
    """A small striped float64 GeoTIFF of (rows, cols) or (rows, cols, bands) values, pixel interleaved."""
    values = np.asarray(values, dtype="<f8").reshape(values.shape[0], values.shape[1], bands)
    rows, cols = values.shape[:2]
    strips = [values[r : r + rows_per_strip].tobytes() for r in range(0, rows, rows_per_strip)]
    strips = [zlib.compress(s) for s in strips] if deflate else strips
    entries = [
        (256, 4, (cols,)), (257, 4, (rows,)), (258, 3, (64,) * bands), (259, 3, (8 if deflate else 1,)), (262, 3, (1,)),
        (273, 4, (0,) * len(strips)), (277, 3, (bands,)), (278, 4, (rows_per_strip,)),
        (279, 4, tuple(len(s) for s in strips)), (284, 3, (1,)), (339, 3, (3,) * bands), (33550, 12, (dx, dy, 0.0)),
        (33922, 12, (0.0, 0.0, 0.0, xmin, ymax, 0.0)),
    ]
    extra_at = 8 + 2 + 12 * len(entries) + 4
    sizes = [len(v) * FIELD_TYPES[t][1] for _, t, v in entries]
    data_at = extra_at + sum(s for s in sizes if s > 4)
    offsets, at = [], data_at
    for s in strips:
        offsets.append(at)
        at += len(s)
    table, extra = b"", b""
    for (tag, kind, vals), size in zip(entries, sizes):
        vals = tuple(offsets) if tag == 273 else vals
        packed = struct.pack("<" + str(len(vals)) + FIELD_TYPES[kind][0], *vals)
        if size > 4:
            table += struct.pack("<HHII", tag, kind, len(vals), extra_at + len(extra))
            extra += packed
        else:
            table += struct.pack("<HHI", tag, kind, len(vals)) + packed.ljust(4, b"\0")
    head = struct.pack("<2sHIH", b"II", 42, 8, len(entries)) + table + struct.pack("<I", 0)
    return head + extra + b"".join(strips)


def write_rasters(tiles: DataFrame, path: str, deflate: bool = False, bands: int = 1) -> DataFrame:
    """Write one file per row (source, xmin, ymax, dx, dy, cols, values) and return the file names.

    With two bands the second holds -1 minus the first. With a column `at` (and `rows`) it says where
    the values lie, row by row; the other pixels are NaN."""

    def write(batches):
        for pdf in batches:
            names = []
            for t in pdf.itertuples(index=False):
                grid = np.asarray(t.values, dtype=float)
                if "at" in pdf:
                    given, grid = grid, np.full(t.rows * t.cols, np.nan)
                    grid[np.asarray(t.at, dtype=np.int64)] = given
                grid = grid.reshape(-1, t.cols)
                grid = np.stack([grid, -1.0 - grid], axis=2) if bands == 2 else grid
                system, base = fs.FileSystem.from_uri(path)
                system.create_dir(base, recursive=True)
                with system.open_output_stream(f"{base}/{t.source}.tif") as out:
                    out.write(encode_geotiff(grid, t.xmin, t.ymax, t.dx, t.dy, deflate=deflate, bands=bands))
                names.append(t.source)
            yield pd.DataFrame({"source": names})

    return tiles.mapInPandas(write, "source string")
