"""Raw inputs to clean tables: towers, population, buildings, elevation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siteplan.operators.clean import TEST_BOX, TRAIN_BOX, bbox_split, build_towers, clean_buildings, clean_elevation
from siteplan.operators.footprints import geojson_rings, ring_buildings
from siteplan.operators.profile import building_profile
from siteplan.operators.raster import tiles_to_points
from siteplan.session import kept
from siteplan.sources.geotiff import read_raster_tiles
from siteplan.sources.readers import read_cells_csv, read_geojson
from siteplan.sources.sinks import write_per_source, write_table


def towers_job(spark: SparkSession, cells_csv: str, out: str) -> None:
    write_table(build_towers(read_cells_csv(spark, cells_csv)), out)


def population_job(spark: SparkSession, raster: str, out: str, box=TRAIN_BOX) -> None:
    write_table(tiles_to_points(read_raster_tiles(spark, raster, box=box), box), out)


def buildings_job(spark: SparkSession, geojson: str, train_out: str, test_out: str, batch: str | None = None) -> None:
    """Footprints of both regions; with `batch`, a re-run replaces what that batch wrote before."""
    rings = geojson_rings(read_geojson(spark, geojson))
    buildings = kept(ring_buildings(rings, [TRAIN_BOX, TEST_BOX]), "buildings")  # made once for both regions
    for part, path in zip(bbox_split(buildings, "center_longitude", "center_latitude"), (train_out, test_out)):
        write_table(part, path, batch=batch)


def clean_buildings_job(spark: SparkSession, buildings: str, out: str, files: int = 96) -> DataFrame:
    """Write the buildings with a believable area and return the counts that were judged by."""
    raw = spark.read.parquet(buildings)
    write_table(clean_buildings(raw), out, files=files)
    return building_profile(raw)


def elevation_job(
    spark: SparkSession, rasters: str, out: str, stride: int = 1, width: float | None = 1.0, per_source: bool = False
) -> None:
    """All elevation rasters of a folder as one table; stride 100 thins one-arc-second tiles to about 0.01°."""
    keep = ("source",) if per_source else ()
    pixels = tiles_to_points(
        read_raster_tiles(spark, rasters, stride=stride),
        anchor="corner",
        width=width,
        names=("longitude", "latitude", "elevation"),
        keep=keep,
    )
    if per_source:
        write_per_source(clean_elevation(pixels), out)
    else:
        write_table(clean_elevation(pixels), out)
