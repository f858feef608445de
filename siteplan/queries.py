"""Every operator as a query over the given tables, with equivalent plain SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.fixtures import oracle, table, view
from siteplan.functions.geo import point_to_wkt, rect_area, rect_to_wkt, wkt_to_rect
from siteplan.functions.register import register_functions
from siteplan.functions.scoring import DECAY_K, point_score
from siteplan.operators import clean, generators, layout, profile, radius, raster, scale
from siteplan.operators.aggregates import count, deviation, mean, merge_partials, total
from siteplan.operators.attach import attach
from siteplan.operators.footprints import geojson_rings, ring_buildings
from siteplan.operators.grid import fan_out
from siteplan.operators.mlp import initial_vector, mlp_score, step_gradient, training_blocks, weights_table
from siteplan.operators.placement import argmax_row, greedy_place
from siteplan.operators.range_join import BOUNDS, range_join, range_join_wkt
from siteplan.operators.regression import regression_metrics
from siteplan.plans import inputs
from siteplan.plans import places as places_plan
from siteplan.plans import points as points_plan
from siteplan.schemas import BUILDING_RADII, BUILDINGS, CELLS_RAW, FEATURE_RADII, PLACE_FEATURES, POINT_FEATURES, POPULATION, TOWERS, radius_suffix
from siteplan.session import kept, scratch_dir
from siteplan.raster_fixture import write_rasters
from siteplan.sources.geotiff import read_raster_bands, read_raster_tiles
from siteplan.sources.readers import read_cells_csv, read_csv_folder, read_geojson, read_points_csv
from siteplan.sources.sinks import load_model, load_net, save_model, save_net, write_csv, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LON_LAT = ("lon", "lat")
CENTRE = ("center_longitude", "center_latitude")
PIXEL = ("longitude", "latitude")
B = ", ".join(BOUNDS)


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = oracle(sql)
        return fn

    return add


def _in(x: str, y: str, strict: bool = True) -> str:
    lo, hi = (">", "<") if strict else (">=", "<=")
    return f"{x} {lo} lon1 AND {x} {hi} lon2 AND {y} {lo} lat1 AND {y} {hi} lat2"


def _d(x: str, y: str) -> str:
    return f"SQRT((p.lon - {x}) * (p.lon - {x}) + (p.lat - {y}) * (p.lat - {y}))"


def _exact(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,5))) AS DOUBLE)"


# --- towers and cleaning -----------------------------------------------------------------


@query("SELECT radio, mcc, cell, lon, lat FROM cells WHERE radio = 'LTE' AND mcc IN ('310','311','312','313','314','315','316')")
def filter_codes(spark, sf):
    return clean.filter_codes(view(spark, sf, "cells"))


@query("SELECT bsid, lon, lat FROM towers")
def tower_cluster(spark, sf):
    towers = clean.build_towers(view(spark, sf, "cells"))
    return towers.withColumns({c: F.round(c, 6) for c in LON_LAT})


@query(
    "SELECT 'train' AS part, center_longitude, center_latitude, area FROM buildings "
    "WHERE center_longitude >= -125 AND center_longitude <= -71 AND center_latitude >= 33 AND center_latitude <= 42 "
    "UNION ALL SELECT 'test' AS part, center_longitude, center_latitude + 13e0, area FROM buildings "
    "WHERE center_longitude >= -124 AND center_longitude <= -117 AND center_latitude + 13e0 >= 46 AND center_latitude + 13e0 <= 48"
)
def bbox_split(spark, sf):
    b = view(spark, sf, "buildings")
    train, _ = clean.bbox_split(b, *CENTRE)
    # the given positions lie in the training region only; moved north, some reach the other one
    _, test = clean.bbox_split(b.withColumn("center_latitude", F.col("center_latitude") + 13.0), *CENTRE)
    return train.select(F.lit("train").alias("part"), "*").union(test.select(F.lit("test").alias("part"), "*"))


@query("SELECT * FROM buildings WHERE area <> 0 AND area < 500000")
def building_clean(spark, sf):
    return clean.clean_buildings(view(spark, sf, "buildings"))


@query("SELECT longitude, latitude, elevation FROM elev_clean")
def elev_clean(spark, sf):
    return clean.clean_elevation(view(spark, sf, "elev"))


_GAPS = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS v, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS c FROM orders"


@query(f"SELECT k, COALESCE(v, 0) AS v, COALESCE(c, 0) AS c FROM ({_GAPS}) q")
def fill_zero(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    gaps = o.select(
        k.alias("k"), F.when(k % 3 != 0, F.col("o_totalprice")).alias("v"), F.when(k % 4 != 0, F.col("o_custkey")).alias("c")
    )
    return clean.fill_zero(gaps)


@query("SELECT DISTINCT center_longitude, center_latitude FROM buildings")
def dedup_rows(spark, sf):
    return clean.dedup_rows(view(spark, sf, "buildings").select(*CENTRE))


@query("SELECT lon, lat FROM towers UNION ALL SELECT lon, lat FROM points UNION ALL SELECT lon, lat FROM pop")
def union_all(spark, sf):
    return clean.union_all([view(spark, sf, n).select(*LON_LAT) for n in ("towers", "points", "pop")])


@query("SELECT lon, lat, bsid, NULL AS pop_cnt FROM towers UNION ALL SELECT lon, lat, NULL AS bsid, pop_cnt FROM pop")
def union_by_name(spark, sf):
    return clean.union_by_name([view(spark, sf, "towers"), view(spark, sf, "pop").select("pop_cnt", "lat", "lon")])


@query(
    "SELECT l_suppkey, l_orderkey, l_extendedprice FROM (SELECT l_suppkey, l_orderkey, l_extendedprice, ROW_NUMBER() OVER "
    "(PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey) AS rn FROM lineitem) q WHERE rn = 1"
)
def nearest_row(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_extendedprice")
    return clean.nearest_row(rows, ["l_suppkey"], ["l_extendedprice", "l_orderkey"])


# --- profiles, samples, layout -----------------------------------------------------------


@query(
    "SELECT 'pop_cnt' AS \"column\", COUNT(pop_cnt) AS \"count\", " + _exact("pop_cnt") + " / COUNT(pop_cnt) AS mean, "
    "ROUND(STDDEV_SAMP(pop_cnt), 6) AS stddev, MIN(pop_cnt) AS \"min\", MAX(pop_cnt) AS \"max\" FROM pop"
)
def profile_numeric(spark, sf):
    stats = profile.profile_numeric(view(spark, sf, "pop"), ["pop_cnt"], quartiles=False, scale=5)
    return stats.withColumn("stddev", F.round("stddev", 6))


@query("SELECT unnest(['area', 'center_longitude', 'center_latitude']) AS \"column\", TRUE AS p25, TRUE AS p50, TRUE AS p75, CAST(COUNT(*) AS BIGINT) AS \"count\" FROM buildings")
def profile_quartiles(spark, sf):
    """Whether each approximate quartile's rank is within a thousandth of what it should be."""
    b = view(spark, sf, "buildings")
    found = profile.profile_numeric(b, ["area", *CENTRE])
    each = b.select(F.expr("stack(3, 'area', area, 'center_longitude', center_longitude, 'center_latitude', center_latitude) AS (column, v)"))
    shares = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    held = each.join(F.broadcast(found.select("column", *[p for p, _ in shares])), "column")  # three rows
    near = [
        (F.avg(F.when(F.col("v") < F.col(p), 1.0).otherwise(0.0)) <= q + 1e-3) & (F.avg(F.when(F.col("v") <= F.col(p), 1.0).otherwise(0.0)) >= q - 1e-3)
        for p, q in shares
    ]
    return held.groupBy("column").agg(*[n.alias(p) for n, (p, _) in zip(near, shares)], F.count("*").alias("count"))


@query("SELECT COUNT(*) AS buildings, COUNT(CASE WHEN area = 0 THEN 1 END) AS zero_area, COUNT(CASE WHEN area >= 500000 THEN 1 END) AS large_area FROM buildings")
def building_profile(spark, sf):
    return profile.building_profile(view(spark, sf, "buildings"))


def _draw(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5({key} || '|{seed}'), 1, 13) AS BIGINT)"


def _drawn(key: str, fraction: float, seed: int) -> str:
    return f"{_draw(key, seed)} < {round(fraction * 2**52)}"


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE {_drawn('o_orderkey', 0.1, 7)}")
def sample_rows(spark, sf):
    return layout.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 0.1, 7, ["o_orderkey"])


@query(f"SELECT o_orderkey, CAST({_draw('o_orderkey', 0)} % 12 AS INT) AS shard FROM orders")
def shard_rows(spark, sf):
    return layout.shard(table(spark, sf, "orders").select("o_orderkey"), 12)


@query(f"SELECT o_orderkey, o_custkey, {_draw('o_orderkey', 31)} % 1000000 < 200000 AS test FROM orders")
def split_train_test(spark, sf):
    train, test = layout.split_train_test(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])
    return train.withColumn("test", F.lit(False)).union(test.withColumn("test", F.lit(True)))


@query("SELECT lon, lat, pop_cnt FROM pop")
def relayout(spark, sf):
    return layout.relayout(view(spark, sf, "pop"), 24, cell=1.0)


@query("SELECT o_orderkey, CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) / 2000e0) AS BIGINT) AS chunk FROM orders")
def chunk_rows(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", (-F.col("o_totalprice")).alias("neg"))
    return layout.chunk_rows(rows, ["neg", "o_orderkey"], 2000).select("o_orderkey", "chunk")


# --- generators --------------------------------------------------------------------------


def _corner(axis: int) -> str:
    low, span = (-125, 54) if axis % 2 == 0 else (33, 9)
    return f"{low}e0 + {span}e0 * (CAST('0x' || substr(md5(id || '|5|' || k || '|{axis}'), 1, 13) AS BIGINT) / {2**52}e0)"


@query(
    f"SELECT id, LEAST(a, c) AS lon1, LEAST(b, d) AS lat1, GREATEST(a, c) AS lon2, GREATEST(b, d) AS lat2 FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY k) AS rn "
    f"FROM (SELECT id, k, {_corner(0)} AS a, {_corner(1)} AS b, {_corner(2)} AS c, {_corner(3)} AS d FROM (SELECT c_custkey AS id, unnest(range(256)) AS k FROM customer) i) q "
    "WHERE ABS(a - c) BETWEEN 5e-1 AND 1e1 AND ABS(b - d) BETWEEN 5e-1 AND 1e1) r WHERE rn = 1"
)
def gen_places(spark, sf):
    """A random place for every customer."""
    return generators.gen_places(spark, seed=5, ids=table(spark, sf, "customer").select(F.col("c_custkey").alias("id")))


@query(
    "SELECT l.lon, l.lat, COUNT(*) AS customers FROM (SELECT -125 + i * 4e-2 AS lon, 33 + j * 4e-2 AS lat, i * 225 + j AS id "
    "FROM (SELECT range AS i FROM range(1350)) a, (SELECT range AS j FROM range(225)) b) l "
    "JOIN customer c ON l.id = (c.c_custkey * 7919) % 303750 GROUP BY l.lon, l.lat"
)
def gen_lattice(spark, sf):
    lattice = generators.gen_lattice(spark)
    # the lattice positions customers hash to, found by position number
    i, j = F.round((F.col("lon") + 125) / 0.04).cast("long"), F.round((F.col("lat") - 33) / 0.04).cast("long")
    homes = table(spark, sf, "customer").groupBy(((F.col("c_custkey") * 7919) % 303750).alias("id")).agg(F.count("*").alias("customers"))
    return lattice.withColumn("id", i * 225 + j).join(homes, "id").select("lon", "lat", "customers")


# --- places ------------------------------------------------------------------------------

_MILES = "CASE ABS(CAST(TRUNC((lat1 - lat2) / 2e0 + lat2) AS INT)) WHEN 33 THEN 58.07e0 WHEN 34 THEN 57.41e0 WHEN 35 THEN 56.72e0 WHEN 36 THEN 56.02e0 WHEN 37 THEN 55.31e0 WHEN 38 THEN 54.58e0 WHEN 39 THEN 53.83e0 WHEN 40 THEN 53.07e0 WHEN 41 THEN 52.28e0 WHEN 42 THEN 51.38e0 WHEN 46 THEN 48.13e0 WHEN 47 THEN 47.26e0 WHEN 48 THEN 46.37e0 END"
_AREA = f"ROUND(ABS(lon1 - lon2) * ({_MILES}) * ABS(lat1 - lat2) * 69e0, 4)"


@query(f"SELECT {B}, {_AREA} AS area FROM places")
def rect_area_query(spark, sf):
    return view(spark, sf, "places").withColumn("area", F.round(rect_area(*BOUNDS), 4))


QUERIES["rect_area"] = QUERIES.pop("rect_area_query")
ORACLES["rect_area"] = ORACLES.pop("rect_area_query")


@query(f"SELECT {B}, COUNT(t.lon) AS cell_tower_num FROM places LEFT JOIN towers t ON {_in('t.lon', 't.lat')} GROUP BY {B}")
def place_tower_count(spark, sf):
    aggs = {"cell_tower_num": count("bsid", "lon", "lat")}
    return range_join(view(spark, sf, "places"), view(spark, sf, "towers"), LON_LAT, aggs)


@query(f"SELECT {B}, {_exact('pop_cnt')} AS pop_cnt_sum FROM places LEFT JOIN pop ON {_in('lon', 'lat')} GROUP BY {B}")
def place_pop_sum(spark, sf):
    return range_join(view(spark, sf, "places"), view(spark, sf, "pop"), LON_LAT, {"pop_cnt_sum": total("pop_cnt", 5)})


@query(f"SELECT {B}, {_exact('pop_cnt')} / COUNT(pop_cnt) AS pop_den FROM places LEFT JOIN pop ON {_in('lon', 'lat')} GROUP BY {B}")
def place_pop_avg(spark, sf):
    return range_join(view(spark, sf, "places"), view(spark, sf, "pop"), LON_LAT, {"pop_den": mean("pop_cnt", 5)})


@query(
    f"SELECT {B}, pop_cnt_sum / MAX(pop_cnt_sum) OVER () AS pop_cnt_sum_norm FROM (SELECT {B}, {_exact('pop_cnt')} AS pop_cnt_sum "
    f"FROM places LEFT JOIN pop ON {_in('lon', 'lat')} GROUP BY {B}) q"
)
def place_pop_norm(spark, sf):
    return scale.normalise_by_max(place_pop_sum(spark, sf), "pop_cnt_sum", "pop_cnt_sum_norm")


@query(
    "SELECT 'POLYGON ((' || x1 || ' ' || y1 || ', ' || x2 || ' ' || y1 || ', ' || x2 || ' ' || y2 || ', ' || x1 || ' ' || y2 || ', ' || x1 || ' ' || y1 || '))' "
    "AS rectangle, pop_cnt_sum FROM (SELECT CAST(lon1 AS VARCHAR) AS x1, CAST(lat1 AS VARCHAR) AS y1, CAST(lon2 AS VARCHAR) AS x2, CAST(lat2 AS VARCHAR) AS y2, "
    f"{_exact('pop_cnt')} AS pop_cnt_sum FROM places JOIN pop ON {_in('lon', 'lat')} GROUP BY {B}) q"
)
def place_pop_wkt(spark, sf):
    return range_join_wkt(view(spark, sf, "places"), view(spark, sf, "pop"), LON_LAT, {"pop_cnt_sum": total("pop_cnt", 5)})


@query(
    "SELECT 'POINT (' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')' AS wkt, lon AS lon1, lat AS lat1, lon + 1 AS lon2, lat + 1 AS lat2 FROM towers"
)
def rect_wkt(spark, sf):
    t = view(spark, sf, "towers")
    back = wkt_to_rect(rect_to_wkt("lon", "lat", F.col("lon") + 1, F.col("lat") + 1))
    return t.select(point_to_wkt("lon", "lat").alias("wkt"), *[back[c].alias(c) for c in BOUNDS])


@query(
    f"SELECT {B}, {_exact('elevation')} / COUNT(elevation) AS avg_elevation, COALESCE(ROUND(STDDEV_SAMP(elevation), 6), 0) AS stddv_elevation "
    f"FROM places JOIN elev_clean ON {_in('longitude', 'latitude', False)} GROUP BY {B}"
)
def place_elevation(spark, sf):
    aggs = {"avg_elevation": mean("elevation", 5), "stddv_elevation": deviation("elevation", 5)}
    found = range_join(view(spark, sf, "places"), view(spark, sf, "elev_clean"), PIXEL, aggs, strict=False, how="inner")
    return clean.fill_zero(found, list(aggs)).withColumn("stddv_elevation", F.round("stddv_elevation", 6))


_PIXEL_KEY = "CAST(CAST(ROUND(longitude * 1e3) AS BIGINT) * 100000 + CAST(ROUND(latitude * 1e3) AS BIGINT) AS {})"


@query(
    f"SELECT {B}, {_exact('elevation')} / COUNT(elevation) AS avg_elevation, COALESCE(ROUND(STDDEV_SAMP(elevation), 6), 0) AS stddv_elevation "
    f"FROM places JOIN (SELECT * FROM elev_clean WHERE {_drawn(_PIXEL_KEY.format('VARCHAR'), 0.2, 3)}) e ON {_in('longitude', 'latitude', False)} GROUP BY {B}"
)
def place_elevation_sampled(spark, sf):
    aggs = {"avg_elevation": mean("elevation", 5), "stddv_elevation": deviation("elevation")}
    pixels = view(spark, sf, "elev_clean").selectExpr("*", _PIXEL_KEY.format("STRING") + " AS k")
    pixels = layout.sample_rows(pixels, 0.2, 3, ["k"])
    found = range_join(view(spark, sf, "places"), pixels, PIXEL, aggs, strict=False, how="inner")
    return clean.fill_zero(found, list(aggs)).withColumn("stddv_elevation", F.round("stddv_elevation", 6))


_BUILDING_AGGS = {"building_count": count("area"), "building_area": total("area", 5)}


@query(
    f"SELECT {B}, COUNT(area) AS building_count, {_exact('area')} AS building_area FROM places LEFT JOIN buildings "
    f"ON {_in('center_longitude', 'center_latitude')} GROUP BY {B}"
)
def place_building_partial(spark, sf):
    return range_join(view(spark, sf, "places"), view(spark, sf, "buildings"), CENTRE, _BUILDING_AGGS)


def _building_batches(spark, sf):
    """Buildings in eight batches by area, as if they arrived in eight files."""
    return view(spark, sf, "buildings").withColumn("batch", F.floor("area").cast("long") % 8)


_BATCHES = "SELECT center_longitude, center_latitude, area, CAST(FLOOR(area) AS BIGINT) % 8 AS batch FROM buildings"


@query(
    f"SELECT batch, CAST(COUNT(area) AS BIGINT) AS total_building_cnt, {_exact('area')} AS total_building_area FROM ({_BATCHES}) q GROUP BY batch"
)
def merge_partials_query(spark, sf):
    b = _building_batches(spark, sf)
    parts = b.groupBy("batch", F.floor("center_longitude").alias("g")).agg(
        F.count("area").alias("n"), F.sum(F.col("area").cast("decimal(18,5)")).alias("a")
    )
    merged = merge_partials(parts, ["batch"], {"total_building_cnt": "n", "total_building_area": "a"})
    return merged.withColumn("total_building_area", F.col("total_building_area").cast("double"))


QUERIES["merge_partials"] = QUERIES.pop("merge_partials_query")
ORACLES["merge_partials"] = ORACLES.pop("merge_partials_query")


@query(
    f"SELECT {B}, {_AREA} AS area, COUNT(b.area) AS total_building_cnt, {_exact('b.area')} AS total_building_area FROM places LEFT JOIN buildings b "
    f"ON {_in('center_longitude', 'center_latitude')} GROUP BY {B}"
)
def place_building_combine(spark, sf):
    places = view(spark, sf, "places")
    partials = range_join(places, view(spark, sf, "buildings"), CENTRE, _BUILDING_AGGS)
    totals = merge_partials(partials, list(BOUNDS), {"total_building_cnt": "building_count", "total_building_area": "building_area"})
    return attach(places.withColumn("area", F.round(rect_area(*BOUNDS), 4)), totals, list(BOUNDS))


# --- points ------------------------------------------------------------------------------

_DT, _DP, _DB, _DE = _d("t.lon", "t.lat"), _d("q.lon", "q.lat"), _d("center_longitude", "center_latitude"), _d("longitude", "latitude")
_ND = f"SELECT p.lon, p.lat, COUNT(*) - 1 AS n, MIN({_DT}) AS d FROM points p LEFT JOIN towers t ON {_DT} < 1.0e0 GROUP BY p.lon, p.lat"


@query(_ND)
def point_n_d(spark, sf):
    return radius.nearest_and_count(view(spark, sf, "points"), view(spark, sf, "towers"), 1.0)


@query(
    "SELECT lon, lat, n, d, ROUND(CASE WHEN d IS NULL THEN 0 ELSE 1 / (2 + 47 * d) END + 5e-1 * (1 - 1 / POW(LN(n + 40e0) / LN(40e0), 2)), 9) AS score "
    f"FROM ({_ND}) q"
)
def point_score_query(spark, sf):
    return point_n_d(spark, sf).withColumn("score", F.round(point_score("n", "d"), 9))


QUERIES["point_score"] = QUERIES.pop("point_score_query")
ORACLES["point_score"] = ORACLES.pop("point_score_query")

_INV = f"SELECT p.lon, p.lat, ROUND(SUM(1 / ({_DT} * {_DT})), 6) AS score FROM points p LEFT JOIN towers t ON {_DT} < 0.4e0 GROUP BY p.lon, p.lat"


@query(_INV)
def point_score_invsq(spark, sf):
    scored = radius.inverse_square_score(view(spark, sf, "points"), view(spark, sf, "towers"))
    return scored.withColumn("score", F.round("score", 6))


@query(f"SELECT s.lon, s.lat, s.score, p.lon * 2 AS feature FROM ({_INV}) s LEFT JOIN points p ON s.lon = p.lon AND s.lat = p.lat")
def point_score_invsq_attach(spark, sf):
    features = view(spark, sf, "points").withColumn("feature", F.col("lon") * 2)
    return attach(point_score_invsq(spark, sf), features, ["lon", "lat"], "left")


def _pop_cols(radii) -> str:
    return ", ".join(
        f"CAST(SUM(CASE WHEN {_DP} < {r}e0 THEN CAST(pop_cnt AS DECIMAL(18,5)) END) AS DOUBLE) AS pop_{radius_suffix(r)}_sum" for r in radii
    )


def _building_cols(radii) -> str:
    return ", ".join(
        f"COUNT(CASE WHEN {_DB} < {r}e0 THEN 1 END) AS building_cnt_{radius_suffix(r)}, "
        f"COALESCE(CAST(SUM(CASE WHEN {_DB} < {r}e0 THEN CAST(area AS DECIMAL(18,5)) END) AS DOUBLE), 0) AS building_area_{radius_suffix(r)}"
        for r in radii
    )


_POP = f"SELECT p.lon, p.lat, {_pop_cols(FEATURE_RADII)} FROM points p LEFT JOIN pop q ON {_DP} < 0.4e0 GROUP BY p.lon, p.lat"
_BUILD = f"SELECT p.lon, p.lat, {_building_cols(BUILDING_RADII)} FROM points p LEFT JOIN buildings b ON {_DB} < 0.4e0 GROUP BY p.lon, p.lat"


@query(_POP)
def point_pop_multi(spark, sf):
    return radius.radius_features(
        view(spark, sf, "points"), view(spark, sf, "pop"), {"pop_{}_sum": total("pop_cnt", 5)}, FEATURE_RADII
    )


@query(_BUILD)
def point_building_multi(spark, sf):
    aggs = {"building_cnt_{}": count(), "building_area_{}": total("area", 5)}
    return radius.radius_features(
        view(spark, sf, "points"), view(spark, sf, "buildings"), aggs, BUILDING_RADII, other_xy=CENTRE, fill_zero=True
    )


@query(f"SELECT a.lon, a.lat, a.n, a.d, b.* EXCLUDE (lon, lat) FROM ({_ND}) a JOIN ({_BUILD}) b ON a.lon = b.lon AND a.lat = b.lat")
def point_building_combine(spark, sf):
    return attach(point_n_d(spark, sf), point_building_multi(spark, sf), ["lon", "lat"])


@query(
    f"SELECT p.lon, p.lat, {_DB} AS dist, b.area FROM points p LEFT JOIN buildings b ON {_DB} < 0.4e0"
)
def point_neighbour_list(spark, sf):
    lists = radius.neighbour_list(view(spark, sf, "points"), view(spark, sf, "buildings"), "area", other_xy=CENTRE)
    pair = F.explode_outer("neighbours").alias("pair")
    rows = lists.select("lon", "lat", F.size("neighbours").alias("k"), pair)
    return rows.select("lon", "lat", F.col("pair")[0].alias("dist"), F.col("pair")[1].alias("area"))


@query(
    "SELECT p.lon, p.lat, "
    + ", ".join(
        f"CAST(COUNT(CASE WHEN {_DB} < {r}e0 THEN 1 END) AS BIGINT) AS building_cnt_{radius_suffix(r)}, "
        f"ROUND(COALESCE(SUM(CASE WHEN {_DB} < {r}e0 THEN area END), 0), 2) AS building_area_{radius_suffix(r)}"
        for r in BUILDING_RADII
    )
    + f" FROM points p LEFT JOIN buildings b ON {_DB} < 0.4e0 GROUP BY p.lon, p.lat"
)
def list_split_radius(spark, sf):
    lists = radius.neighbour_list(view(spark, sf, "points"), view(spark, sf, "buildings"), "area", other_xy=CENTRE)
    areas = [f"building_area_{radius_suffix(r)}" for r in BUILDING_RADII]
    return radius.lists_to_features(lists, BUILDING_RADII).withColumns({a: F.round(a, 2) for a in areas})


def _rank(r: float) -> str:
    return (
        f"(SELECT lon, lat, pr AS elevRank_{radius_suffix(r)} FROM (SELECT p.lon, p.lat, PERCENT_RANK() OVER (PARTITION BY p.lon, p.lat "
        f"ORDER BY elevation NULLS FIRST) AS pr, ROW_NUMBER() OVER (PARTITION BY p.lon, p.lat ORDER BY {_DE}, longitude, latitude) AS rn "
        f"FROM points p LEFT JOIN elev_clean e ON {_DE} < {r}e0) w WHERE rn = 1)"
    )


@query(
    f"SELECT * FROM {_rank(0.01)} a JOIN {_rank(0.03)} b USING (lon, lat) JOIN {_rank(0.1)} c USING (lon, lat) JOIN {_rank(0.4)} d USING (lon, lat)"
)
def point_elev_rank(spark, sf):
    return radius.neighbour_percent_rank(view(spark, sf, "points"), view(spark, sf, "elev_clean"))


# --- building outlines -------------------------------------------------------------------

_X, _Y = "((l_orderkey * 7919 + l_linenumber * 31) % 54000 - 125000)", "((l_orderkey * 104729 + l_partkey) % 9000 + 33000)"
_CORNER = f"{_X} / 1e3 AS x, {_Y} / 1e3 AS y"


def _features(spark: SparkSession, sf: str) -> DataFrame:
    """Outlines derived from lineitem, one GeoJSON line each, its type going by the line number."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.monotonically_increasing_id().alias("at"))
    # spread before the text is made, by row numbers, which need no sort: outlines come in many files
    rows = items.repartition(fan_out(items), "at").selectExpr("l_orderkey", "l_linenumber", _X + " / 1e3 AS x", _Y + " / 1e3 AS y")

    def ring(dx: float, dy: float, w: float, h: float, z: str = "") -> str:
        corners = [(0, 0), (w, 0), (w, h), (0, h), (0, 0)]
        return "'[" + ",".join(f"[' || round(x + {dx + a}, 4) || ',' || round(y + {dy + b}, 4) || '{z}]" for a, b in corners) + "]'"

    shapes = {
        1: ("Polygon", f"'[' || {ring(0, 0, 0.01, 0.02)} || ']'"),
        2: ("Polygon", f"'[' || {ring(0, 0, 0.02, 0.02)} || ',' || {ring(0.01, 0.01, 0.002, 0.002)} || ']'"),
        3: ("MultiPolygon", f"'[[' || {ring(0, 0, 0.01, 0.01)} || ',' || {ring(0.002, 0.002, 0.004, 0.004)} || ']]'"),
        4: ("MultiPolygon", f"'[[' || {ring(0, 0, 0.01, 0.01)} || ',' || {ring(0.002, 0.002, 0.004, 0.004)} || '],[' || {ring(0.02, 0.02, 0.01, 0.01)} || ']]'"),
        5: ("LineString", ring(0, 0, 0.01, 0.01)),
        6: ("Point", "'[' || x || ',' || y || ']'"),
        7: ("Polygon", f"'[' || {ring(0, 0, 0.01, 0.01, ',5')} || ']'"),
    }
    kind = "CASE l_linenumber " + " ".join(f"WHEN {k} THEN '{t}'" for k, (t, _) in shapes.items()) + " END"
    text = "CASE l_linenumber " + " ".join(f"WHEN {k} THEN {t}" for k, (_, t) in shapes.items()) + " END"
    line = f"""'{{"type":"Feature","properties":{{"k":"' || l_orderkey || '"}},"geometry":{{"type":"' || {kind} || '","coordinates":' || {text} || '}}}}'"""
    return rows.selectExpr(line + " AS value")


def _geojson(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "geojson")
    _features(spark, sf).write.text(path)
    return read_geojson(spark, path)


# per line number: type, and the rings' offsets and sides
_RINGS = {
    1: ("Polygon", [(0, 0, 0.01, 0.02)]),
    2: ("Polygon", [(0, 0, 0.02, 0.02), (0.01, 0.01, 0.002, 0.002)]),
    3: ("MultiPolygon", [(0, 0, 0.01, 0.01), (0.002, 0.002, 0.004, 0.004)]),
    4: ("MultiPolygon", [(0, 0, 0.01, 0.01), (0.02, 0.02, 0.01, 0.01)]),
    5: ("LineString", [(0, 0, 0.01, 0.01)]),
    7: ("Polygon", [(0, 0, 0.01, 0.01)]),
}
_RING_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS type, ROUND(x + {dx}e0, 4) AS x, ROUND(y + {dy}e0, 4) AS y, {w}e0 AS w, {h}e0 AS h FROM "
    f"(SELECT {_CORNER} FROM lineitem WHERE l_linenumber = {k}) q{k}_{i}"
    for k, (t, rings) in _RINGS.items()
    for i, (dx, dy, w, h) in enumerate(rings)
)


@query("SELECT CASE l_linenumber WHEN 3 THEN 'MultiPolygon' WHEN 4 THEN 'MultiPolygon' WHEN 5 THEN 'LineString' WHEN 6 THEN 'Point' ELSE 'Polygon' END AS type, COUNT(*) AS features FROM lineitem GROUP BY 1")
def src_geojson(spark, sf):
    return _geojson(spark, sf).groupBy("type").agg(F.count("coordinates").alias("features"))


_VERTICES = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))


@query(
    " UNION ALL ".join(
        f"SELECT type, {i} AS vertex, ROUND(x + {a} * w, 4) AS x, ROUND(y + {b} * h, 4) AS y FROM ({_RING_SQL}) r{i}"
        for i, (a, b) in enumerate(_VERTICES)
    )
)
def geojson_rings_query(spark, sf):
    each = geojson_rings(_geojson(spark, sf)).select("type", F.posexplode("ring").alias("vertex", "p"))
    return each.select("type", "vertex", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


@query(f"SELECT type, ROUND(x + w / 2, 6) AS cx, ROUND(y + h / 2, 6) AS cy FROM ({_RING_SQL}) r")
def ring_centroid(spark, sf):
    rings = ring_buildings(geojson_rings(_geojson(spark, sf)), keep=("type",))
    return rings.select("type", F.round("center_longitude", 6).alias("cx"), F.round("center_latitude", 6).alias("cy"))


def _northing(lat: str) -> str:
    e = 0.00669437999014**0.5
    s = f"({e}e0 * SIN(RADIANS({lat})))"
    return f"6378137e0 * LN(TAN(0.7853981633974483e0 + RADIANS({lat}) / 2) * POW((1 - {s}) / (1 + {s}), {e / 2}e0))"


@query(
    f"SELECT type, ROUND(RADIANS(w) * 6378137e0 * (({_northing('ROUND(y + h, 4)')}) - ({_northing('y')})), 0) AS area FROM ({_RING_SQL}) r"
)
def ring_area_3395(spark, sf):
    rings = ring_buildings(geojson_rings(_geojson(spark, sf)), keep=("type",))
    return rings.select("type", F.round("area", 0).alias("area"))


QUERIES["geojson_rings"] = QUERIES.pop("geojson_rings_query")
ORACLES["geojson_rings"] = ORACLES.pop("geojson_rings_query")


# --- files -------------------------------------------------------------------------------


_RAW = {
    "net": "CAST(cell % 7 AS VARCHAR)", "area": "CAST(cell % 1000 AS VARCHAR)", "unit": "mcc", "range": "CAST(cell % 50 AS VARCHAR)",
    "samples": "CAST(cell % 11 AS VARCHAR)", "changeable": "CASE WHEN cell % 2 = 0 THEN NULL ELSE '1' END", "created": "radio",
    "updated": "CAST(cell AS VARCHAR)", "averageSignal": "'0'",
}


def _cells_csv(spark: SparkSession, sf: str) -> str:
    """The cells in their 14 raw columns as a folder of CSV files."""
    path = scratch_dir(spark, "cells-csv")
    made = view(spark, sf, "cells").selectExpr("*", *[f"{e.replace('VARCHAR', 'STRING')} AS `{c}`" for c, e in _RAW.items()])
    write_csv(made.select(*CELLS_RAW.names), path)
    return path


@query("SELECT radio, mcc, cell, lon, lat, " + ", ".join(f'{e} AS "{c}"' for c, e in _RAW.items()) + " FROM cells")
def src_csv_schema(spark, sf):
    return read_cells_csv(spark, _cells_csv(spark, sf))


@query("SELECT lon, lat, pop_cnt FROM pop")
def src_csv_infer(spark, sf):
    path = scratch_dir(spark, "pop-csv")
    write_csv(view(spark, sf, "pop"), path)
    return read_points_csv(spark, path)


@query("SELECT lon, lat, pop_cnt FROM pop UNION ALL SELECT lon, lat, NULL AS pop_cnt FROM points")
def src_csv_folder(spark, sf):
    path = scratch_dir(spark, "folder-csv")
    write_csv(view(spark, sf, "pop"), path)
    write_csv(view(spark, sf, "points").select("lat", "lon"), path, mode="append")
    return read_csv_folder(spark, path)


@query("SELECT center_longitude, center_latitude, area, CAST(CAST(FLOOR(area) AS BIGINT) % 8 AS VARCHAR) AS batch FROM buildings")
def write_batches(spark, sf):
    path = scratch_dir(spark, "batches")
    rows = _building_batches(spark, sf).select(*BUILDINGS.names, F.col("batch").cast("string").alias("batch"))
    write_table(rows.where("batch < '4'").drop("batch"), path, batch="first")
    write_table(rows.where("batch >= '4'").drop("batch"), path, batch="second")
    write_table(rows.where("batch >= '4'").drop("batch"), path, batch="second")  # a rerun replaces its batch
    back = spark.read.parquet(path)
    return back.select(*BUILDINGS.names, (F.floor("area").cast("long") % 8).cast("string").alias("batch"))


# 60 × 20 pixel grids over one-degree files: a pixel per order key and a file per 1,200 keys,
# so both grow with orders; a pixel without an order is NaN
_GRID = (
    "SELECT fx, fy, c, r, MAX(v) AS v FROM (SELECT CAST(-125 + o_orderkey // 1200 % 60 AS BIGINT) AS fx, "
    "CAST(33 + o_orderkey // 72000 AS BIGINT) AS fy, CAST(o_orderkey * 31 % 60 AS BIGINT) AS c, "
    "CAST(o_orderkey % 1200 // 60 AS BIGINT) AS r, CAST(o_custkey AS DOUBLE) AS v FROM orders) g GROUP BY fx, fy, c, r"
)


def _tif_files(spark: SparkSession, sf: str, deflate: bool, bands: int = 1) -> str:
    """A folder of raster files made from orders: one 60 × 20 file per square degree and 1,200 order keys."""
    k = F.col("o_orderkey")
    pixels = (
        table(spark, sf, "orders")
        .select(
            F.expr("o_orderkey div 1200 % 60 - 125").cast("long").alias("fx"),
            F.expr("o_orderkey div 72000 + 33").cast("long").alias("fy"),
            ((k * 31) % 60).cast("int").alias("c"),
            F.expr("o_orderkey % 1200 div 60").cast("int").alias("r"),
            F.col("o_custkey").cast("double").alias("v"),
        )
        .groupBy("fx", "fy", "c", "r")
        .agg(F.max("v").alias("v"))
    )
    # a file is 1,200 pixels whatever the table size; those without an order stay NaN
    found = F.collect_list(F.struct((F.col("r") * 60 + F.col("c")).alias("k"), "v"))
    files = (
        # spread by a fixed number: adaptive execution would merge the small pixel rows, and a task write most files
        pixels.repartition(fan_out(pixels), "fx", "fy").groupBy("fx", "fy")
        .agg(found.alias("found"))
        .select(
            F.concat_ws("_", F.lit("deg"), F.abs("fx").cast("string"), F.col("fy").cast("string")).alias("source"),
            F.col("fx").cast("double").alias("xmin"),
            (F.col("fy") + 1).cast("double").alias("ymax"),
            F.lit(1 / 60).alias("dx"),
            F.lit(1 / 20).alias("dy"),
            F.lit(60).alias("cols"),
            F.lit(20).alias("rows"),
            F.col("found.k").alias("at"),
            F.col("found.v").alias("values"),
        )
    )
    path = scratch_dir(spark, "tif")
    write_rasters(files, path, deflate, bands).count()
    return path


def _tifs(spark: SparkSession, sf: str, deflate: bool, bands: int = 1, **options) -> DataFrame:
    return read_raster_tiles(spark, _tif_files(spark, sf, deflate, bands), **options)


_NEAR = "ROUND(fx + (c + 5e-1) / 60, 6) AS lon, ROUND(fy + 1 - (r + 5e-1) / 20, 6) AS lat"
_UPPER_LEFT = "ROUND(fx + c / 6e1, 6) AS longitude, ROUND(fy + 1 - r / 2e1, 6) AS latitude"


@query(f"SELECT {_NEAR}, v AS pop_cnt FROM ({_GRID}) g")
def src_raster_single(spark, sf):
    points = raster.tiles_to_points(_tifs(spark, sf, False))
    return points.withColumns({c: F.round(c, 6) for c in LON_LAT})


@query(f"SELECT {_NEAR}, v AS pop_cnt FROM ({_GRID}) g WHERE fx + (c + 5e-1) / 60 > -124 AND fx + (c + 5e-1) / 60 < -121.5 AND fy + 1 - (r + 5e-1) / 20 > 33.26e0 AND fy + 1 - (r + 5e-1) / 20 < 35")
def raster_to_points_box(spark, sf):
    box = (-124.0, 33.26, -121.5, 35.0)
    points = raster.tiles_to_points(_tifs(spark, sf, True, box=box), box=box)
    return points.withColumns({c: F.round(c, 6) for c in LON_LAT})


_ELEV_NAMES = ("longitude", "latitude", "elevation")


@query(f"SELECT {_UPPER_LEFT}, v AS elevation FROM ({_GRID}) g")
def raster_to_points_corner(spark, sf):
    pixels = raster.tiles_to_points(_tifs(spark, sf, True), anchor="corner", width=1.0, names=_ELEV_NAMES)
    return clean.clean_elevation(pixels).withColumns({c: F.round(c, 6) for c in PIXEL})


@query(f"SELECT {_UPPER_LEFT}, v AS elevation, -1 - v AS second FROM ({_GRID}) g")
def src_raster_multi(spark, sf):
    tiles = read_raster_bands(spark, _tif_files(spark, sf, True, bands=2), (0, 1))
    names = (*_ELEV_NAMES, "second")
    pixels = raster.tiles_to_points(tiles, anchor="corner", width=1.0, names=names, bands=("band0", "band1"))
    return clean.clean_elevation(pixels).withColumns({c: F.round(c, 6) for c in PIXEL})


@query(f"SELECT {_UPPER_LEFT}, v AS elevation FROM ({_GRID}) g WHERE r % 5 = 0 AND c % 5 = 0")
def raster_downsample(spark, sf):
    pixels = raster.tiles_to_points(_tifs(spark, sf, False, stride=5), anchor="corner", width=1.0, names=_ELEV_NAMES)
    return clean.clean_elevation(pixels).withColumns({c: F.round(c, 6) for c in PIXEL})


@query(f"SELECT 'deg_' || ABS(fx) || '_' || fy AS source, COUNT(*) AS pixels, MAX(v) AS highest FROM ({_GRID}) g GROUP BY fx, fy")
def src_per_file(spark, sf):
    pixels = raster.tiles_to_points(_tifs(spark, sf, False), keep=("source",))
    path = scratch_dir(spark, "per-file")
    pixels.write.partitionBy("source").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("source").agg(F.count("*").alias("pixels"), F.max("pop_cnt").alias("highest"))


_BINS = ["v < 0", *[f"v >= {a} AND v < {a + 250}" for a in (0, 250, 500, 750)], "v >= 1000"]


@query(
    "SELECT 'deg_' || ABS(fx) || '_' || fy AS source, CAST(60 AS BIGINT) AS cols, CAST(20 AS BIGINT) AS rows, CAST(COUNT(*) AS BIGINT) AS valid_cells, "
    f"COUNT(*) / 1200e0 AS valid_share, MIN(v) AS \"min\", MAX(v) AS \"max\", SUM(v) / COUNT(*) AS mean, "
    + ", ".join(f"CAST(SUM(CASE WHEN {t} THEN 1 ELSE 0 END) AS BIGINT) AS bin_{i}" for i, t in enumerate(_BINS))
    + f" FROM ({_GRID}) g GROUP BY fx, fy"
)
def raster_profile(spark, sf):
    stats = profile.raster_profile(_tifs(spark, sf, False), bins=4, low=0.0, high=1000.0)
    return stats.select("*", *[F.col("histogram")[i].alias(f"bin_{i}") for i in range(6)]).drop("histogram")


# --- scaling and models ------------------------------------------------------------------

_FEATURES = [f"f{i}" for i in range(1, 12)]


@query(
    "SELECT event_id, "
    + ", ".join(f"ROUND((f{i} - AVG(f{i}) OVER ()) / STDDEV_SAMP(f{i}) OVER (), 8) AS f{i}" for i in range(1, 12))
    + " FROM features"
)
def standard_scale(spark, sf):
    return scale.standard_scale(view(spark, sf, "features"), _FEATURES).withColumns({c: F.round(c, 8) for c in _FEATURES})


@query(
    "SELECT event_id, "
    + ", ".join(f"(f{i} - MIN(f{i}) OVER ()) / (MAX(f{i}) OVER () - MIN(f{i}) OVER ()) AS f{i}" for i in range(1, 12))
    + " FROM features"
)
def minmax_scale(spark, sf):
    return scale.minmax_scale(view(spark, sf, "features"), _FEATURES)


@query(
    "SELECT COUNT(*) AS n, ROUND(AVG((f1 - f2) * (f1 - f2)), 6) AS mse, ROUND(SQRT(AVG((f1 - f2) * (f1 - f2))), 6) AS rmse, "
    "ROUND(1 - AVG((f1 - f2) * (f1 - f2)) / VAR_POP(f1), 6) AS r2 FROM features"
)
def regression_metrics_query(spark, sf):
    found = regression_metrics(view(spark, sf, "features"), "f1", "f2")
    return found.withColumns({c: F.round(c, 6) for c in ("mse", "rmse", "r2")})


QUERIES["regression_metrics"] = QUERIES.pop("regression_metrics_query")
ORACLES["regression_metrics"] = ORACLES.pop("regression_metrics_query")


@query(
    "SELECT event_id, ROUND(1 / (1 + EXP(-(5e-1 * GREATEST(1e-2 * f1 - 2e-2 * f2 + 1e-1, 0) - 25e-2 * GREATEST(3e-2 * f3 - 1e0, 0) + 2e-1))), 9) AS score FROM features"
)
def mlp_score_query(spark, sf):
    vector = np.array([0.01, -0.02, 0.0, 0.0, 0.0, 0.03, 0.1, -1.0, 0.5, -0.25, 0.2])
    weights = weights_table(spark, vector, [3, 2, 1])
    scored = mlp_score(view(spark, sf, "features"), ["f1", "f2", "f3"], weights, out="sigmoid")
    return scored.select("event_id", F.round("score", 9).alias("score"))


QUERIES["mlp_score"] = QUERIES.pop("mlp_score_query")
ORACLES["mlp_score"] = ORACLES.pop("mlp_score_query")


@query(
    "SELECT event_id, ROUND(1 / (1 + EXP(-(5e-1 * GREATEST(1e0 * f1 - 2e0 * f2 + 1e-1, 0) - 25e-2 * GREATEST(3e0 * f3 - 1e0, 0) + 2e-1))), 9) AS score FROM ("
    "SELECT event_id, " + ", ".join(f"(f{i} - MIN(f{i}) OVER ()) / (MAX(f{i}) OVER () - MIN(f{i}) OVER ()) AS f{i}" for i in (1, 2, 3)) + " FROM features) q"
)
def net_store(spark, sf):
    """A net and its ranges, written, read back and applied."""
    path, names = scratch_dir(spark, "net"), _FEATURES[:3]
    rows = view(spark, sf, "features").select("event_id", *names)
    vector = np.array([1.0, -2.0, 0.0, 0.0, 0.0, 3.0, 0.1, -1.0, 0.5, -0.25, 0.2])
    save_net(weights_table(spark, vector, [3, 2, 1]), scale.minmax_ranges(rows, names), path)
    weights, ranges = load_net(spark, path)
    scored = mlp_score(scale.minmax_scale(rows, names, ranges), names, weights, out="sigmoid")
    return scored.select("event_id", F.round("score", 9).alias("score"))


@query(f"SELECT s.lon, s.lat, s.score, COALESCE(CASE WHEN p.lon > -100 THEN p.lon * 2 END, 0) AS feature FROM ({_INV}) s JOIN points p ON s.lon = p.lon AND s.lat = p.lat")
def rescore_points(spark, sf):
    table_ = view(spark, sf, "points").withColumns({"score": F.lit(0.5), "feature": F.when(F.col("lon") > -100, F.col("lon") * 2)})
    return points_plan.rescore_points(table_, view(spark, sf, "towers")).withColumn("score", F.round("score", 6))


# --- placement ---------------------------------------------------------------------------


def _scored_points(spark, sf):
    """The points with a score in [0, 1) drawn from their position."""
    mixed = F.col("lon") * 7919 + F.col("lat") * 104729
    return view(spark, sf, "points").withColumn("score", mixed * 1.37 % 1.0)


@query(
    "SELECT lon, lat, pop_cnt FROM pop ORDER BY pop_cnt DESC, lon, lat LIMIT 1"
)
def argmax_point(spark, sf):
    return argmax_row(view(spark, sf, "pop"), "pop_cnt", ["lon", "lat"])


def _greedy_sql(scored: str, n: int, radius: float) -> str:
    """The choice one by one: state rows are keyed (0, id), picks (1, step)."""
    d = "SQRT((s.lon - b.lon) * (s.lon - b.lon) + (s.lat - b.lat) * (s.lat - b.lat))"
    return f"""
    WITH RECURSIVE base AS (SELECT row_number() OVER (ORDER BY lon, lat) AS id, lon, lat, score FROM ({scored}) p),
    run(kind, id, lon, lat, score, step) USING KEY (kind, id) AS (
      SELECT 0, id, lon, lat, score, 0 FROM base
      UNION ALL
      (WITH best AS (SELECT id, lon, lat, score FROM recurring.run WHERE kind = 0 ORDER BY score DESC, lon, lat LIMIT 1),
            turn AS (SELECT MAX(step) + 1 AS step FROM run)
       SELECT 1, turn.step, b.lon, b.lat, b.score, turn.step FROM best b, turn WHERE turn.step <= {n}
       UNION ALL
       SELECT 0, s.id, s.lon, s.lat, s.score - {DECAY_K:.6e} / ({d} * {d} + {DECAY_K:.6e}), turn.step
       FROM recurring.run s, best b, turn WHERE s.kind = 0 AND turn.step <= {n} AND {d} < {radius}e0))
    SELECT step AS pick, lon, lat, ROUND(score, 9) AS score FROM run WHERE kind = 1"""


@query()
def greedy_placement(spark, sf):
    return greedy_place(_scored_points(spark, sf), 1000).withColumn("score", F.round("score", 9))


_SCORED = "SELECT lon, lat, ((lon * 7919 + lat * 104729) * 1.37e0) % 1e0 AS score FROM points"
_PLACED = oracle(_greedy_sql(_SCORED, 1000, 0.4).strip().replace("WITH RECURSIVE", "WITH", 1))
ORACLES["greedy_placement"] = _PLACED.replace("WITH ", "WITH RECURSIVE ", 1)


@query(f"SELECT {B}, {_AREA} AS area, ROUND(SQRT((lon1 - lon2) * (lon1 - lon2) + (lat1 - lat2) * (lat1 - lat2)), 9) AS diagonal, "
       "ROUND(CASE WHEN lon2 > lon1 + 5 THEN 0 ELSE 1 / (2 + 47 * (lon2 - lon1)) END + 5e-1 * (1 - 1 / POW(LN(CAST(FLOOR(lat2) AS BIGINT) + 40e0) / LN(40e0), 2)), 9) AS score, "
       "ROUND(1 / ((lon2 - lon1) * (lon2 - lon1)), 9) AS inverse, ROUND(1.6e-5 / ((lat2 - lat1) * (lat2 - lat1) + 1.6e-5), 12) AS decay FROM places")
def sql_functions(spark, sf):
    register_functions(spark)
    text = "SELECT *, ROUND(rect_area(lon1, lat1, lon2, lat2), 4) AS area, ROUND(dist(lon1, lat1, lon2, lat2), 9) AS diagonal, "
    text += "ROUND(point_score(CAST(FLOOR(lat2) AS BIGINT), CASE WHEN lon2 > lon1 + 5 THEN NULL ELSE lon2 - lon1 END), 9) AS score, "
    text += "ROUND(inverse_square(lon2 - lon1), 9) AS inverse, ROUND(decay_penalty(lat2 - lat1), 12) AS decay FROM {p}"
    return spark.sql(text, p=view(spark, sf, "places"))


# --- whole jobs from files to files ------------------------------------------------------


@query("SELECT bsid, lon, lat FROM towers")
def job_towers(spark, sf):
    out = scratch_dir(spark, "towers")
    inputs.towers_job(spark, _cells_csv(spark, sf), out)
    return spark.read.schema(TOWERS).parquet(out).withColumns({c: F.round(c, 6) for c in LON_LAT})


@query(f"SELECT {_NEAR}, v AS pop_cnt FROM ({_GRID}) g WHERE fx + (c + 5e-1) / 60 > -123.5 AND fx + (c + 5e-1) / 60 < -120 AND fy + 1 - (r + 5e-1) / 20 > 33 AND fy + 1 - (r + 5e-1) / 20 < 35.5e0")
def job_population(spark, sf):
    out = scratch_dir(spark, "population")
    inputs.population_job(spark, _tif_files(spark, sf, True), out, (-123.5, 33.0, -120.0, 35.5))
    return spark.read.schema(POPULATION).parquet(out).withColumns({c: F.round(c, 6) for c in LON_LAT})


@query(f"SELECT ROUND(x + w / 2, 6) AS center_longitude, ROUND(y + h / 2, 6) AS center_latitude, ROUND(RADIANS(w) * 6378137e0 * (({_northing('ROUND(y + h, 4)')}) - ({_northing('y')})), 0) AS area FROM ({_RING_SQL}) r WHERE x + w / 2 <= -71 AND y + h / 2 <= 42")
def job_buildings(spark, sf):
    """Outlines to buildings of the training region, as two batches of which one is run twice."""
    path, train, test = (scratch_dir(spark, n) for n in ("geojson", "train", "test"))
    lines = _features(spark, sf).withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2)))
    for half in (0, 1):
        lines.limit(0).select("value").write.text(f"{path}/half={half}")  # a half may come without a line
    lines.write.mode("append").partitionBy("half").text(path)
    for half in (0, 1, 1):
        inputs.buildings_job(spark, f"{path}/half={half}", train, test, batch=f"part{half}")
    return spark.read.parquet(train).select(*[F.round(c, 6).alias(c) for c in CENTRE], F.round("area", 0).alias("area"))


@query("SELECT center_longitude, center_latitude, area, CAST(96 AS BIGINT) AS files FROM buildings WHERE area <> 0 AND area < 500000")
def job_clean_buildings(spark, sf):
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "clean")
    write_table(view(spark, sf, "buildings"), raw, mode="error")
    inputs.clean_buildings_job(spark, raw, out)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(out).select("path")
    return spark.read.schema(BUILDINGS).parquet(out).withColumn("files", files.agg(F.count("*")).scalar())


@query(f"SELECT {_UPPER_LEFT}, v AS elevation, 'deg_' || ABS(fx) || '_' || fy AS source FROM ({_GRID}) g WHERE r % 4 = 0 AND c % 4 = 0")
def job_elevation(spark, sf):
    out = scratch_dir(spark, "elevation")
    inputs.elevation_job(spark, _tif_files(spark, sf, True, bands=2), out, stride=4, per_source=True)
    return spark.read.parquet(out).withColumns({c: F.round(c, 6) for c in PIXEL})


@query("SELECT lon, lat, pop_cnt, TRUE AS refused FROM pop")
def write_modes(spark, sf):
    """A table replaced by overwrite; a write that must not replace it is refused."""
    out = scratch_dir(spark, "modes")
    write_table(view(spark, sf, "points").select(*LON_LAT, F.lit(0.0).alias("pop_cnt")), out)
    write_table(view(spark, sf, "pop"), out)
    try:
        write_table(view(spark, sf, "pop"), out, mode="error")
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.schema(POPULATION).parquet(out).withColumn("refused", F.lit(refused))


# --- whole feature tables ----------------------------------------------------------------


def _tables(spark, sf) -> list[DataFrame]:
    return [view(spark, sf, n) for n in ("towers", "pop", "elev_clean")] + [clean.clean_buildings(view(spark, sf, "buildings"))]


_PLACE_FEATURES = (
    f"SELECT e.*, t.cell_tower_num, q.pop_cnt_sum_norm, b.total_building_cnt, b.total_building_area FROM ("
    f"SELECT {B}, {_AREA} AS area, ROUND({_exact('elevation')} / COUNT(elevation), 6) AS avg_elevation, COALESCE(ROUND(STDDEV_SAMP(elevation), 6), 0) AS stddv_elevation FROM places JOIN elev_clean ON {_in('longitude', 'latitude', False)} GROUP BY {B}) e "
    f"JOIN (SELECT {B}, COUNT(t.lon) AS cell_tower_num FROM places LEFT JOIN towers t ON {_in('t.lon', 't.lat')} GROUP BY {B}) t USING ({B}) "
    f"JOIN (SELECT {B}, s / MAX(s) OVER () AS pop_cnt_sum_norm FROM (SELECT {B}, {_exact('pop_cnt')} AS s FROM places LEFT JOIN pop ON {_in('lon', 'lat')} GROUP BY {B}) r) q USING ({B}) "
    f"JOIN (SELECT {B}, COUNT(area) AS total_building_cnt, {_exact('area')} AS total_building_area FROM places LEFT JOIN "
    f"(SELECT * FROM buildings WHERE area <> 0 AND area < 500000) k ON {_in('center_longitude', 'center_latitude')} GROUP BY {B}) b USING ({B})"
)


@query(_PLACE_FEATURES)
def place_features(spark, sf):
    table_ = places_plan.place_features(view(spark, sf, "places"), *_tables(spark, sf), scale=5)
    return table_.withColumns({"area": F.round("area", 4), "avg_elevation": F.round("avg_elevation", 6), "stddv_elevation": F.round("stddv_elevation", 6)})


_ND4 = _ND.replace("< 1.0e0", "< 0.4e0").replace("COUNT(*) - 1", "GREATEST(COUNT(t.lon) - 1, 0)")
_CLEAN_BUILD = _BUILD.replace("JOIN buildings b", "JOIN (SELECT * FROM buildings WHERE area <> 0 AND area < 500000) b")


_POINT_FEATURES = (
    "SELECT a.*, ROUND(CASE WHEN a.d IS NULL THEN 0 ELSE 1 / (2 + 47 * a.d) END + 5e-1 * (1 - 1 / POW(LN(a.n + 40e0) / LN(40e0), 2)), 9) AS score, "
    f"b.* EXCLUDE (lon, lat), r1.elevRank_1d, r2.elevRank_3d, r3.elevRank_10d, r4.elevRank_40d, q.* EXCLUDE (lon, lat) FROM ({_ND4}) a "
    f"JOIN ({_CLEAN_BUILD}) b USING (lon, lat) JOIN {_rank(0.01)} r1 USING (lon, lat) JOIN {_rank(0.03)} r2 USING (lon, lat) "
    f"JOIN {_rank(0.1)} r3 USING (lon, lat) JOIN {_rank(0.4)} r4 USING (lon, lat) JOIN ({_POP}) q USING (lon, lat)"
)


@query(_POINT_FEATURES)
def point_features(spark, sf):
    found = points_plan.point_features(view(spark, sf, "points"), *_tables(spark, sf), scale=5)
    return found.withColumn("score", F.round("score", 9))


_NET = np.array([((i * 37) % 19 - 9) / 10 for i in range(2 * 22)] + [0.3, -0.2, 1.5, -1.2, 0.1])


def _net_sql(features: str, out: str) -> str:
    """The rows of `features` (lon, lat and the model's columns), scaled and scored by the net above."""
    names = POINT_FEATURES
    scaled = ", ".join(
        f"CASE WHEN MAX({c}) OVER () = MIN({c}) OVER () THEN c.{c} - MIN({c}) OVER () ELSE (c.{c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ()) END AS {c}" for c in names
    )
    filled = ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in names)
    unit = lambda u: " + ".join(f"({float(_NET[22 * u + i])!r}::DOUBLE * {c})" for i, c in enumerate(names)) + f" + {float(_NET[44 + u])!r}::DOUBLE"
    net = f"{float(_NET[46])!r}::DOUBLE * GREATEST({unit(0)}, 0) + {float(_NET[47])!r}::DOUBLE * GREATEST({unit(1)}, 0) + {float(_NET[48])!r}::DOUBLE"
    return f"SELECT lon, lat, 1 / (1 + EXP(-({net}))) AS {out} FROM (SELECT lon, lat, {scaled} FROM (SELECT lon, lat, {filled} FROM ({features}) f) c) g"


@query()
def place_sites(spark, sf):
    """All 22 features of the points, scored by a net with fixed weights, and the 1000 best sites."""
    table_ = kept(points_plan.point_features(view(spark, sf, "points"), *_tables(spark, sf), scale=5), "point-features")
    sites = points_plan.place_sites(table_, weights_table(spark, _NET, [22, 2, 1]))
    return sites.withColumn("score", F.round("score", 9))


_SITES = oracle(_greedy_sql(_net_sql(_POINT_FEATURES, "score"), 1000, 0.4).strip().replace("WITH RECURSIVE", "WITH", 1))
ORACLES["place_sites"] = _SITES.replace("WITH ", "WITH RECURSIVE ", 1)


# --- regression and training -------------------------------------------------------------

_LABEL = "cell_tower_num"


def _split_sql(rows: str, keys: list[str], test: str, held: str) -> str:
    """Two named tables: the rows by the hash of their keys, one in five held back."""
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    bucket = f"{_draw(key, 31)} % 1000000"
    return f"{test} AS MATERIALIZED (SELECT * FROM ({rows}) a WHERE {bucket} >= 200000), {held} AS MATERIALIZED (SELECT * FROM ({rows}) a WHERE {bucket} < 200000)"


def _regression_sql() -> str:
    """Named tables of the regression on the place features: moments, the equations solved by elimination, predictions."""
    names, n = PLACE_FEATURES, len(PLACE_FEATURES)
    filled = f"SELECT {B}, " + ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in [*names, _LABEL]) + f" FROM ({_PLACE_FEATURES}) f"
    z = ", ".join(f"COALESCE((a.{c} - m.m{i}) / NULLIF(m.s{i}, 0), 0) AS z{i}" for i, c in enumerate(names))
    steps = [
        _split_sql(filled, list(BOUNDS), "train", "held"),
        "m AS MATERIALIZED (SELECT " + ", ".join(f"AVG({c}) AS m{i}, STDDEV_SAMP({c}) AS s{i}" for i, c in enumerate(names)) + f", AVG({_LABEL}) AS my FROM train)",
        f"z AS (SELECT {z}, a.{_LABEL} - m.my AS zy FROM train a, m)",
        "e0 AS MATERIALIZED (SELECT " + ", ".join([f"AVG(z{i} * z{j}) AS a{i}{j}" for i in range(n) for j in range(n)] + [f"AVG(z{i} * zy) AS a{i}{n}" for i in range(n)]) + " FROM z)",
    ]
    for k in range(n):
        cells = [f"a{k}{j} / a{k}{k} AS a{k}{j}" for j in range(n + 1)]
        cells += [f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k} AS a{i}{j}" for i in range(n) if i != k for j in range(n + 1)]
        steps.append(f"e{k + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM e{k})")
    value = " + ".join(f"e.a{i}{n} * COALESCE((a.{c} - m.m{i}) / NULLIF(m.s{i}, 0), 0)" for i, c in enumerate(names))
    steps.append(f"predicted AS (SELECT {', '.join('a.' + c for c in BOUNDS)}, a.{_LABEL} AS y, m.my + {value} AS prediction FROM held a, m, e{n} e)")
    return "WITH " + ", ".join(steps)


def _rounded(df, *names):
    return df.withColumns({c: F.round(c, 6) for c in names})


@query(
    f"{_regression_sql()} SELECT COUNT(*) AS n, ROUND(AVG((y - prediction) ** 2), 6) AS mse, ROUND(SQRT(AVG((y - prediction) ** 2)), 6) AS rmse, "
    "ROUND(1 - AVG((y - prediction) ** 2) / VAR_POP(y), 6) AS r2 FROM predicted"
)
def ml_place_regression(spark, sf):
    """Measures, on held-back places, of the pipeline fitted on the features of the places."""
    table_ = kept(QUERIES["place_features"](spark, sf), "place-features")
    return _rounded(places_plan.train_place_model(table_)[1], "mse", "rmse", "r2")


@query(
    f"{_regression_sql()} SELECT 0 AS position, '(intercept)' AS feature, NULL::DOUBLE AS mean, NULL::DOUBLE AS deviation, ROUND(my, 6) AS coefficient FROM m UNION ALL "
    + " UNION ALL ".join(
        f"SELECT {i + 1}, '{c}', ROUND(m{i}, 6), ROUND(s{i}, 6), ROUND(a{i}{len(PLACE_FEATURES)}, 6) FROM m, e{len(PLACE_FEATURES)}" for i, c in enumerate(PLACE_FEATURES)
    )
)
def ml_place_coefficients(spark, sf):
    """The regression's coefficients from one pass of sums."""
    table_ = kept(QUERIES["place_features"](spark, sf), "place-features")
    return _rounded(places_plan.train_place_regression(table_)[0], "mean", "deviation", "coefficient")


@query(f"{_regression_sql()} SELECT {B}, ROUND(prediction, 6) AS prediction, ROUND(prediction, 6) AS by_sums FROM predicted")
def ml_model_store(spark, sf):
    """The pipeline written, read back and applied to the held-back places, beside the regression from sums."""
    table_, path = kept(QUERIES["place_features"](spark, sf), "place-features"), scratch_dir(spark, "model")
    save_model(places_plan.train_place_model(table_)[0], path)
    _, held, _ = places_plan.train_place_regression(table_)
    by_sums = held.withColumnRenamed("prediction", "by_sums")
    return _rounded(load_model(spark, path).transform(by_sums).select(*BOUNDS, "prediction", "by_sums"), "prediction", "by_sums")


_NET_INPUTS, _NET_HIDDEN, _NET_STEPS = ["building_cnt_40d", "elevRank_40d", "pop_40d_sum"], 2, 3


def _training_sql() -> str:
    """Named tables of the training: scaled rows, and per step the gradient over all rows and the moved weights (v0, v1 …)."""
    names, n = _NET_INPUTS, len(_NET_INPUTS)
    filled = ", ".join(f"CAST(COALESCE({c}, 0) AS DOUBLE) AS {c}" for c in [*names, "score"])
    low = [f"MIN({c}) OVER ()" for c in names]
    high = [f"MAX({c}) OVER ()" for c in names]
    scaled = ", ".join(f"CASE WHEN {h} = {lo} THEN {c} - {lo} ELSE ({c} - {lo}) / ({h} - {lo}) END AS x{i}" for i, (c, lo, h) in enumerate(zip(names, low, high)))
    rows = f"SELECT lon, lat, {scaled}, score AS y FROM (SELECT DISTINCT lon, lat, {filled} FROM ({_POINT_FEATURES}) f) d"
    start = initial_vector([n, _NET_HIDDEN, 1], 0)
    size = len(start)
    steps = [_split_sql(rows, list(LON_LAT), "train", "held")]
    steps.append("w0 AS MATERIALIZED (SELECT " + ", ".join(f"{float(v)!r}::DOUBLE AS v{i}, 0e0 AS m{i}, 0e0 AS s{i}" for i, v in enumerate(start)) + ")")
    bias, top = n * _NET_HIDDEN, n * _NET_HIDDEN + _NET_HIDDEN
    for t in range(1, _NET_STEPS + 1):
        unit = [" + ".join(f"v{n * u + i} * x{i}" for i in range(n)) + f" + v{bias + u}" for u in range(_NET_HIDDEN)]
        hidden = ", ".join(f"GREATEST({z}, 0) AS h{u}, CAST(({z}) > 0 AS INT) AS on{u}" for u, z in enumerate(unit))
        delta = f"2 * ({' + '.join(f'v{top + u} * h{u}' for u in range(_NET_HIDDEN))} + v{size - 1} - y)"
        slopes = [f"AVG(delta * v{top + u} * on{u} * x{i})" for u in range(_NET_HIDDEN) for i in range(n)]
        slopes += [f"AVG(delta * v{top + u} * on{u})" for u in range(_NET_HIDDEN)] + [f"AVG(delta * h{u})" for u in range(_NET_HIDDEN)] + ["AVG(delta)"]
        steps.append(f"g{t} AS MATERIALIZED (SELECT " + ", ".join(f"{g} AS g{i}" for i, g in enumerate(slopes)) + f" FROM (SELECT *, {delta} AS delta FROM (SELECT *, {hidden} FROM train, w{t - 1}) a) b)")
        rate = 0.01 / (1 + 0.1 * (t - 1))
        moved = ", ".join(
            f"v{i} - {rate!r}::DOUBLE * (m{i} / {1 - 0.9**t!r}::DOUBLE) / (SQRT(s{i} / {1 - 0.999**t!r}::DOUBLE) + 1e-8) AS v{i}, m{i}, s{i}" for i in range(size)
        )
        eased = ", ".join(f"v{i}, 9e-1 * m{i} + 1e-1 * g{i} AS m{i}, 999e-3 * s{i} + 1e-3 * g{i} * g{i} AS s{i}" for i in range(size))
        steps.append(f"w{t} AS MATERIALIZED (SELECT {moved} FROM (SELECT {eased} FROM w{t - 1}, g{t}) a)")
    return "WITH " + ", ".join(steps)


def _weight_places() -> list[tuple[int, int, int]]:
    n, h = len(_NET_INPUTS), _NET_HIDDEN
    first = [(0, u, i) for u in range(h) for i in range(n)] + [(0, u, -1) for u in range(h)]
    return first + [(1, 0, u) for u in range(h)] + [(1, 0, -1)]


@query(
    f"{_training_sql()} "
    + " UNION ALL ".join(f"SELECT {layer} AS layer, {i} AS i, {j} AS j, ROUND(v{k}, 6) AS value FROM w{_NET_STEPS}" for k, (layer, i, j) in enumerate(_weight_places()))
)
def mlp_train(spark, sf):
    """The weights of a net after three synchronous steps over the training points."""
    table_ = kept(QUERIES["point_features"](spark, sf), "point-features")
    options = {"hidden": (_NET_HIDDEN,), "epochs": _NET_STEPS, "batches": 1}
    return points_plan.train_point_model(table_, _NET_INPUTS, **options)[0].withColumn("value", F.round("value", 6))


@query(
    f"{_training_sql()} " + " UNION ALL ".join(f"SELECT {i} AS position, ROUND(g{i}, 9) AS slope FROM g1" for i in range(len(_weight_places())))
)
def mlp_gradient(spark, sf):
    """The first step's gradient over all training points."""
    rows = kept(QUERIES["point_features"](spark, sf), "point-features")
    rows = clean.dedup_rows(clean.fill_zero(rows.select(*LON_LAT, *_NET_INPUTS, "score")))
    train, _ = layout.split_train_test(scale.minmax_scale(rows, _NET_INPUTS), list(LON_LAT))
    sizes = [len(_NET_INPUTS), _NET_HIDDEN, 1]
    found = step_gradient(training_blocks(train, _NET_INPUTS, "score"), train.count(), initial_vector(sizes, 0), sizes)
    slopes = spark.createDataFrame([(i, float(g)) for i, g in enumerate(found)], "position int, slope double")
    return slopes.withColumn("slope", F.round("slope", 9))
