"""GeoTIFF files to tile rows.

Files are listed by Spark, one small task per file reads the header and names the byte
ranges of its strips or tiles, and the ranges are then read and decoded by all tasks. A
single large raster is spread over the cluster and never held in one place.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siteplan.schemas import TILES

# Fixed values of the TIFF format: field type -> (struct code, bytes).
FIELD_TYPES = {
    1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 6: ("b", 1),
    8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8),
}
# Fixed values: (sample format, bits) -> numpy type.
SAMPLES = {
    (1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8",
}
# Compression codes for none and for deflate (two codes).
PLAIN, DEFLATE = 1, (8, 32946)

_SEGMENTS = (
    "path string, offset array<long>, nbytes array<long>, row0 long, col0 long, rows int, cols int, seg_cols int, samples int, "
    "dtype string, deflate boolean, predictor int, file_xmin double, file_ymin double, file_xmax double, "
    "file_ymax double, file_cols long, file_rows long, nodata double, band array<int>"
)


def _tile_arrow(outs: tuple[str, ...]) -> pa.Schema:
    """The columns of TILES with one list of pixels per name in `outs`."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fixed = [(f.name, kinds[f.dataType.simpleString()]) for f in TILES if f.name != "band0"]
    return pa.schema([*fixed, *[(o, pa.list_(pa.field("element", pa.float64()))) for o in outs]])


def _open(path: str):
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _tags(file) -> tuple[str, dict]:
    head = file.read_at(8, 0)
    order = "<" if head[:2] == b"II" else ">"
    magic, at = struct.unpack(order + "HI", head[2:8])
    if magic != 42:
        raise ValueError("not a classic TIFF file")
    (n,) = struct.unpack(order + "H", file.read_at(2, at))
    raw = file.read_at(12 * n, at + 2)
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack(order + "HHI", raw[12 * i : 12 * i + 8])
        if kind not in FIELD_TYPES:
            continue
        code, size = FIELD_TYPES[kind]
        inline = raw[12 * i + 8 : 12 * i + 12]
        if count * size > 4:
            inline = file.read_at(count * size, struct.unpack(order + "I", inline)[0])
        if kind == 2:
            tags[tag] = inline[:count].rstrip(b"\0").decode("ascii", "replace")
        else:
            tags[tag] = struct.unpack(order + str(count) + code, inline[: count * size])
    return order, tags


def _segments(path: str, wanted_bands: tuple[int, ...] = (0,)) -> list[tuple]:
    """One tuple per strip or tile: its byte ranges and, per wanted band, the sample in them.

    Interleaved bands share one range; separate planes have a range per band."""
    with _open(path) as file:
        order, tags = _tags(file)
    cols, rows = tags[256][0], tags[257][0]
    compression = tags.get(259, (PLAIN,))[0]
    if compression != PLAIN and compression not in DEFLATE:
        raise ValueError(f"unsupported compression {compression} in {path}")
    bands, planar = tags.get(277, (1,))[0], tags.get(284, (1,))[0]
    kind = SAMPLES[(tags.get(339, (1,))[0], tags.get(258, (1,))[0])]
    dtype = (">" if order == ">" else "<") + kind
    sx, sy = tags[33550][0], tags[33550][1]
    px, py, _, mx, my = tags[33922][:5]
    xmin, ymax = mx - px * sx, my + py * sy
    nodata = float(tags[42113]) if tags.get(42113, "").strip() else None
    if 324 in tags:
        w, h, offsets, sizes = tags[322][0], tags[323][0], tags[324], tags[325]
    else:
        w, h, offsets, sizes = cols, min(tags.get(278, (rows,))[0], rows), tags[273], tags[279]
    across, down = -(-cols // w), -(-rows // h)
    samples = bands if planar == 1 else 1
    if max(wanted_bands) >= bands:
        raise ValueError(f"{path} has {bands} bands")
    # separate planes follow each other
    planes = [0] if planar == 1 else [b * across * down for b in wanted_bands]
    inside = list(wanted_bands) if planar == 1 else [0] * len(wanted_bands)
    out = []
    for i in range(across * down):
        row0, col0 = (i // across) * h, (i % across) * w
        out.append(
            (
                path, [offsets[p + i] for p in planes], [sizes[p + i] for p in planes], row0, col0, min(h, rows - row0), min(w, cols - col0), w, samples, dtype,
                compression != PLAIN, tags.get(317, (1,))[0], xmin, ymax - rows * sy, xmin + cols * sx, ymax, cols, rows,
                nodata, inside,
            )
        )
    return out


def wanted(segment: dict, box: tuple[float, float, float, float] | None, stride: int) -> bool:
    """Whether a segment reaches into the box and holds a row and a column of the stride."""
    edge = _extent(segment)
    if box is not None and not (edge[2] >= box[0] and edge[0] <= box[2] and edge[3] >= box[1] and edge[1] <= box[3]):
        return False
    return -segment["row0"] % stride < segment["rows"] and -segment["col0"] % stride < segment["cols"]


def _extent(s: dict) -> tuple[float, float, float, float]:
    dx = (s["file_xmax"] - s["file_xmin"]) / s["file_cols"]
    dy = (s["file_ymax"] - s["file_ymin"]) / s["file_rows"]
    return (
        s["file_xmin"] + s["col0"] * dx,
        s["file_ymax"] - (s["row0"] + s["rows"]) * dy,
        s["file_xmin"] + (s["col0"] + s["cols"]) * dx,
        s["file_ymax"] - s["row0"] * dy,
    )


def _samples(s: dict, raw: bytes) -> np.ndarray:
    """(row, column, sample) of one byte range."""
    if s["deflate"]:
        raw = zlib.decompress(raw)
    wide = s["seg_cols"] * s["samples"]
    data = np.frombuffer(raw, dtype=s["dtype"], count=len(raw) // (np.dtype(s["dtype"]).itemsize * wide) * wide)
    data = data.reshape(-1, s["seg_cols"], s["samples"])[: s["rows"]]
    if s["predictor"] == 2:
        return np.cumsum(data, axis=1, dtype=data.dtype)
    if s["predictor"] != 1:
        raise ValueError(f"unsupported predictor {s['predictor']} in {s['path']}")
    return data


def _decode(batches, stride: int, outs: tuple[str, ...]):
    """A tile per segment; each byte range is read and decoded once for all its bands."""
    schema = _tile_arrow(outs)
    # Arrow, not pandas: pandas would turn NaN pixels into NULL on the way back
    for batch in batches:
        for s in batch.to_pylist():
            with _open(s["path"]) as file:
                ranges = [_samples(s, file.read_at(n, at)) for at, n in zip(s["offset"], s["nbytes"])]
            row1, col1 = -s["row0"] % stride, -s["col0"] % stride
            dx = (s["file_xmax"] - s["file_xmin"]) / s["file_cols"]
            dy = (s["file_ymax"] - s["file_ymin"]) / s["file_rows"]
            xmin, ymin, xmax, ymax = _extent(s)
            pixels = {}
            for i, (out, sample) in enumerate(zip(outs, s["band"])):
                data = ranges[min(i, len(ranges) - 1)]
                band = data[row1::stride, col1 : s["cols"] : stride, sample].astype(float)
                if s["nodata"] is not None:
                    band[band == s["nodata"]] = np.nan
                pixels[out] = band.ravel()
            row = {
                **s,
                "source": s["path"].rsplit("/", 1)[-1],
                "row0": s["row0"] + row1,
                "col0": s["col0"] + col1,
                "rows": band.shape[0],
                "cols": band.shape[1],
                "step": stride,
                "xmin": xmin + col1 * dx,
                "ymin": ymin,
                "xmax": xmax,
                "ymax": ymax - row1 * dy,
                **pixels,
            }
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)


def read_raster_tiles(
    spark: SparkSession,
    path: str,
    partitions: int | None = None,
    box: tuple[float, float, float, float] | None = None,
    stride: int = 1,
    band: int = 0,
) -> DataFrame:
    """Tile rows of one band of all .tif files at the path; pixels equal to the file's nodata are NaN.

    `source` is the file name without .tif. Plain and deflate files, stripped or tiled. Strips
    and tiles outside `box` (west, south, east, north), or without a row and a column that
    `stride` keeps, are never opened; the others leave the task thinned.
    """
    return _read(spark, path, partitions, box, stride, (band,), ("band0",))


def read_raster_bands(
    spark: SparkSession,
    path: str,
    bands: tuple[int, ...],
    partitions: int | None = None,
    box: tuple[float, float, float, float] | None = None,
    stride: int = 1,
) -> DataFrame:
    """Tile rows with the pixels of several bands, as columns band<number>.

    Headers are read once, and so is each byte range, whether it holds one band or all.
    """
    return _read(spark, path, partitions, box, stride, bands, tuple(f"band{b}" for b in bands))


def _read(spark: SparkSession, path: str, partitions, box, stride: int, bands: tuple[int, ...], outs: tuple[str, ...]) -> DataFrame:
    names = [c.split()[0] for c in _SEGMENTS.split(", ")]

    def listed(batches):
        for pdf in batches:
            for file in pdf["path"]:
                found = [s for s in _segments(file, bands) if wanted(dict(zip(names, s)), box, stride)]
                for i in range(0, len(found), 10_000):
                    yield pd.DataFrame(found[i : i + 10_000], columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path")
    spread = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = files.mapInPandas(listed, _SEGMENTS).repartition(spread)
    pixels = [T.StructField(o, T.ArrayType(T.DoubleType())) for o in outs]
    schema = T.StructType([*[f for f in TILES if f.name != "band0"], *pixels])
    tiles = segments.mapInArrow(lambda batches: _decode(batches, stride, outs), schema)
    return tiles.withColumn("source", F.regexp_replace("source", r"\.tif$", ""))
