"""Column types of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_D = T.DoubleType()


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _D) for n in names]


# Raw antenna records; every code but `cell` is kept as text.
CELLS_RAW = T.StructType(
    [
        T.StructField("radio", T.StringType()),
        T.StructField("mcc", T.StringType()),
        T.StructField("net", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("cell", T.IntegerType()),
        T.StructField("unit", T.StringType()),
        *_doubles("lon", "lat"),
        *[
            T.StructField(n, T.StringType())
            for n in ("range", "samples", "changeable", "created", "updated", "averageSignal")
        ],
    ]
)
TOWERS = T.StructType([T.StructField("bsid", T.LongType()), *_doubles("lon", "lat")])
PLACES = T.StructType([*_doubles("lon1", "lat1", "lon2", "lat2", "area"), T.StructField("cell_tower_num", T.LongType())])
POPULATION = T.StructType(_doubles("lon", "lat", "pop_cnt"))
ELEVATION = T.StructType(_doubles("longitude", "latitude", "elevation"))
BUILDINGS = T.StructType(_doubles("center_longitude", "center_latitude", "area"))
POINT_SCORES = T.StructType([*_doubles("lon", "lat"), T.StructField("n", T.LongType()), *_doubles("d", "score")])
PLACEMENTS = T.StructType(_doubles("lon", "lat", "score"))
BUILDING_PARTIALS = T.StructType(
    [*_doubles("lon1", "lat1", "lon2", "lat2"), T.StructField("building_count", T.LongType()), *_doubles("building_area")]
)

# The members of a feature line. `coordinates` stays text: its nesting depth depends on the geometry type.
GEOJSON = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType([T.StructField("coordinates", T.StringType()), T.StructField("type", T.StringType())]),
        ),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ]
)

# One row per decoded block of a raster; band0 is row-major.
TILES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("row0", T.LongType()),
        T.StructField("col0", T.LongType()),
        *_doubles("xmin", "ymin", "xmax", "ymax"),
        T.StructField("cols", T.IntegerType()),
        T.StructField("rows", T.IntegerType()),
        T.StructField("step", T.IntegerType()),
        *_doubles("file_xmin", "file_ymin", "file_xmax", "file_ymax"),
        T.StructField("file_cols", T.LongType()),
        T.StructField("file_rows", T.LongType()),
        *_doubles("nodata"),
        T.StructField("band0", T.ArrayType(_D)),
    ]
)

# The neighbourhood radii (degrees) and their column suffixes: hundredths of a degree.
BUILDING_RADII = (0.01, 0.02, 0.03, 0.06, 0.1, 0.2, 0.4)
FEATURE_RADII = (0.01, 0.03, 0.1, 0.4)


def radius_suffix(radius: float) -> str:
    """Hundredths of a degree: 0.1 is 10d, and 0.015 is 1_5d."""
    return f"{round(radius * 100, 9):g}d".replace(".", "_")


POINT_FEATURES = (
    [f"building_{kind}_{radius_suffix(r)}" for r in BUILDING_RADII for kind in ("cnt", "area")]
    + [f"elevRank_{radius_suffix(r)}" for r in FEATURE_RADII]
    + [f"pop_{radius_suffix(r)}_sum" for r in FEATURE_RADII]
)
PLACE_FEATURES = ["area", "pop_cnt_sum_norm", "stddv_elevation", "total_building_cnt", "total_building_area"]
