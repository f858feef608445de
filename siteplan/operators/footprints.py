"""Building outlines: GeoJSON geometries to rings, centroids and areas."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siteplan.functions.geo import bind
from siteplan.functions.rings import Rings
from siteplan.schemas import BUILDINGS

_POINT = "array<double>"


def _parsed(depth: int) -> Column:
    kind = _POINT
    for _ in range(depth):
        kind = f"array<{kind}>"
    return F.from_json(F.col("coordinates"), kind)


def _flat(ring: Column) -> Column:
    """Vertices without a third coordinate."""
    return F.transform(ring, lambda p: F.slice(p, 1, 2))


def geojson_rings(df: DataFrame, outer_only: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (type, ring) per ring of at least three vertices, from columns type and coordinates.

    A LineString is one ring. All rings of a Polygon count, holes too, as do those of a
    MultiPolygon of one part; several parts give their outer rings only. `outer_only` skips
    holes everywhere. Other types and unreadable coordinates give no row.
    """
    kind = F.col("type")

    def shown(rings: Column) -> Column:
        return F.slice(rings, 1, 1) if outer_only else rings

    def of_parts(multi: Column) -> Column:
        several = F.transform(multi, lambda part: F.get(part, F.lit(0)))
        return F.when(F.size(multi) == 1, shown(F.get(multi, F.lit(0)))).otherwise(several)

    # each text is parsed once, by its own type only
    rings = (
        F.when(kind == "LineString", F.filter(F.array(_parsed(1)), lambda line: line.isNotNull()))
        .when(kind == "Polygon", shown(_parsed(2)))
        .when(kind == "MultiPolygon", bind(_parsed(3), of_parts))
    )
    exploded = df.select(*keep, "type", F.explode(rings).alias("ring"))
    return exploded.where(~((F.size("ring") < 3) | (kind == "Point"))).withColumn("ring", _flat(F.col("ring")))


def ring_buildings(rings: DataFrame, box=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Buildings (center_longitude, center_latitude, area) of rings; the box is applied before the area.

    `box` is one (west, south, east, north), bounds included, or a list of several, any of which may hold the centre.
    Centroids and areas are made for a whole batch of rings at once.
    """
    boxes = None if box is None else list(box) if isinstance(box[0], (tuple, list)) else [box]
    read = rings.select(*keep, F.col("ring").cast("array<array<double>>").alias("ring"))
    schema = StructType([*read.schema.fields[:-1], *BUILDINGS.fields])
    return read.mapInArrow(lambda batches: _buildings(batches, boxes, schema.names), schema)


def _buildings(batches, boxes: list | None, names: list[str]):
    """The kept columns, centre and area of rings, the last column; those outside all boxes are left out."""
    for batch in batches:
        rings = Rings(batch.column(batch.num_columns - 1))
        centre = rings.centroids()
        (x, has_x), (y, has_y) = centre
        inside = np.ones(len(x), bool)
        if boxes is not None:
            inside = np.zeros(len(x), bool)
            for west, south, east, north in boxes:
                inside |= has_x & has_y & (x >= west) & (x <= east) & (y >= south) & (y <= north)
        found = [pa.array(v, mask=~known) for v, known in (*centre, rings.areas_3395(inside))]
        out = pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=names)
        yield out if boxes is None else out.filter(pa.array(inside))
