"""Placement, geometry, rasters, the net, and the remaining operators on small inputs."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from siteplan.functions.geo import rect_area, rect_to_wkt, ring_area_3395, ring_centroid, wkt_to_rect
from siteplan.functions.scoring import inverse_square, point_score
from siteplan.operators import mlp, placement
from siteplan.operators.clean import build_towers, clean_elevation
from siteplan.operators.footprints import geojson_rings
from siteplan.operators.generators import gen_lattice, gen_places
from siteplan.operators.layout import chunk_rows, split_train_test
from siteplan.operators.placement import greedy_place
from siteplan.operators.raster import tiles_to_points
from siteplan.operators.regression import fit_place_model, regression_metrics
from siteplan.operators.scale import minmax_ranges, minmax_scale, normalise_by_max, standard_scale
from siteplan.session import scratch_dir
from siteplan.raster_fixture import encode_geotiff
from siteplan.sources import geotiff
from siteplan.sources.geotiff import read_raster_bands, read_raster_tiles
from siteplan.sources.readers import read_csv_folder, read_geojson
from siteplan.sources.sinks import load_model, save_model


def one_by_one(pdf, n, radius=0.4, k=1.6e-5):
    pdf = pdf.sort_values(["lon", "lat"])
    x, y, s = pdf.lon.to_numpy(), pdf.lat.to_numpy(), pdf.score.to_numpy().copy()
    picks = []
    for _ in range(n):
        i = int(np.argmax(s))
        picks.append((x[i], y[i], s[i]))
        d = np.sqrt((x - x[i]) ** 2 + (y - y[i]) ** 2)
        s[d < radius] -= k / (d[d < radius] ** 2 + k)
    return picks


@pytest.mark.parametrize("kind", ["random", "equal", "few rows kept"])
def test_greedy_is_the_sequential_choice(spark, kind):
    side = 14
    i, j = np.meshgrid(np.arange(side), np.arange(side))
    pdf = pd.DataFrame({"lon": -125 + i.ravel() * 0.04, "lat": 33 + j.ravel() * 0.04})
    pdf["score"] = 0.5 if kind == "equal" else np.random.default_rng(2).random(side * side)
    n, top = (40, 16) if kind == "few rows kept" else (60, 512)
    got = greedy_place(spark.createDataFrame(pdf), n, top=top).orderBy("pick").collect()
    for row, (x, y, s) in zip(got, one_by_one(pdf, n), strict=True):
        assert (row["lon"], row["lat"]) == (x, y)
        assert row["score"] == pytest.approx(s, abs=1e-12)


def test_greedy_picks_one_site_again_and_takes_empty_input(spark):
    one = spark.createDataFrame([(0.0, 0.0, 0.5)], "lon double, lat double, score double")
    assert [r["score"] for r in greedy_place(one, 3).orderBy("pick").collect()] == [0.5, -0.5, -1.5]
    assert greedy_place(one.where("false"), 3).count() == 0


def test_greedy_writes_only_the_tiles_that_picks_reach(spark, tmp_path, monkeypatch):
    # forty places far apart; three picks touch three of them
    far = pd.DataFrame({"lon": np.repeat(np.arange(40) * 5.0, 50) + np.tile(np.linspace(0, 0.3, 50), 40), "lat": 33.1})
    far["score"] = np.random.default_rng(4).random(len(far))
    monkeypatch.setattr(placement, "scratch_dir", lambda s, label: f"file://{tmp_path}/{label}")
    got = greedy_place(spark.createDataFrame(far), 3).orderBy("pick").collect()
    assert [(r["lon"], r["score"]) for r in got] == [(x, pytest.approx(s)) for x, _, s in one_by_one(far, 3)]
    steps = {int(f.name[5:]): spark.read.parquet(str(f)).count() for f in (tmp_path / "placement" / "state").iterdir()}
    assert steps.pop(0) == 2000
    assert steps and sum(steps.values()) <= 2000 * 3 / 40


def test_greedy_starts_a_new_base_when_changes_outgrow_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(placement, "scratch_dir", lambda s, label: f"file://{tmp_path}/{label}")
    bases, change = [], placement._State.change
    monkeypatch.setattr(placement._State, "change", lambda self, *a: (change(self, *a), bases.append(self.base))[0])
    # one spot picked over and over: its one tile is written in each round
    spot = pd.DataFrame({"lon": [0.0, 0.1, 9.0], "lat": 0.0, "score": [9.0, 0.2, 0.1]})
    got = greedy_place(spark.createDataFrame(spot), 12, top=1).orderBy("pick").collect()
    for row, (x, y, s) in zip(got, one_by_one(spot, 12), strict=True):
        assert (row["lon"], row["score"]) == (x, pytest.approx(s, abs=1e-9))
    assert bases[0] == 0 and max(bases) > 0


def test_rings(spark):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    hole = [[0.5, 0.5], [1, 0.5], [1, 1]]
    shapes = [
        ("Polygon", [square, hole]),
        ("Polygon", [[[0, 0, 9], [3, 0, 9], [0, 3, 9]]]),
        ("MultiPolygon", [[square, hole]]),
        ("MultiPolygon", [[square, hole], [square]]),
        ("LineString", [[0, 0], [4, 0], [4, 0]]),
        ("LineString", [[0, 0], [4, 0]]),
        ("Point", [1, 2]),
        ("MultiLineString", [square]),
        ("Polygon", None),
        (None, [square]),
    ]
    path = scratch_dir(spark, "shapes")
    lines = [json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": t, "coordinates": c}}) for t, c in shapes]
    spark.createDataFrame([(s,) for s in lines], "value string").write.text(path)
    rings = geojson_rings(read_geojson(spark, path)).withColumn("c", ring_centroid("ring"))
    got = sorted((r["type"], len(r["ring"]), round(r["c"]["x"], 9), round(r["c"]["y"], 9)) for r in rings.collect())
    hole_c = (round(2.5 / 3, 9), round(2 / 3, 9))
    assert got == sorted(
        [("Polygon", 5, 1, 1), ("Polygon", 3, *hole_c), ("Polygon", 3, 1, 1), ("MultiPolygon", 5, 1, 1)]
        + [("MultiPolygon", 3, *hole_c), ("MultiPolygon", 5, 1, 1), ("MultiPolygon", 5, 1, 1), ("LineString", 3, 2, 0)]
    )
    assert geojson_rings(read_geojson(spark, path), outer_only=True).count() == 6
    assert all(len(p) == 2 for r in rings.collect() for p in r["ring"])


def test_projected_area_and_wkt(spark):
    ring = [[-100.0, 40.0], [-99.99, 40.0], [-99.99, 40.01], [-100.0, 40.01]]
    df = spark.createDataFrame([(ring,)], "ring array<array<double>>")
    e = math.sqrt(0.00669437999014)
    y = lambda d: 6378137 * (math.atanh(math.sin(math.radians(d))) - e * math.atanh(e * math.sin(math.radians(d))))
    want = 6378137 * math.radians(0.01) * (y(40.01) - y(40.0))
    assert df.select(ring_area_3395("ring")).first()[0] == pytest.approx(want, rel=1e-7)
    back = spark.createDataFrame([(-125.5, 33.0, -1e-5, 42.25)], "a double, b double, c double, d double")
    assert tuple(back.select(wkt_to_rect(rect_to_wkt("a", "b", "c", "d")).alias("r")).select("r.*").first()) == (-125.5, 33.0, -1e-5, 42.25)


def test_scores_and_area(spark):
    df = spark.createDataFrame([(None, None), (0, 0.0), (5, 0.1)], "n bigint, d double")
    got = [r[0] for r in df.select(point_score("n", "d")).collect()]
    crowd = lambda n: 0.5 * (1 - 1 / math.log(n + 40, 40) ** 2)
    assert got == pytest.approx([crowd(0), 0.5 + crowd(0), 1 / (2 + 47 * 0.1) + crowd(5)])
    assert [r[0] for r in df.select(inverse_square("d")).collect()] == [None, None, pytest.approx(100)]
    rects = spark.createDataFrame([(0.0, 33.0, 2.0, 34.0), (0.0, 43.0, 2.0, 44.0)], "a double, b double, c double, d double")
    assert [r[0] for r in rects.select(rect_area("a", "b", "c", "d")).collect()] == [pytest.approx(2 * 58.07 * 69), None]
    with pytest.raises(Exception, match="longitude length"):
        rects.select(rect_area("a", "b", "c", "d", strict=True)).collect()


def test_towers_keep_null_ids(spark):
    cells = spark.createDataFrame(
        [("LTE", "310", 256, 1.0, 2.0), ("LTE", "311", 300, 3.0, 4.0), ("LTE", "310", None, 5.0, 5.0), ("GSM", "310", 1, 0.0, 0.0), ("LTE", "999", 1, 0.0, 0.0)],
        "radio string, mcc string, cell int, lon double, lat double",
    )
    got = sorted(map(tuple, build_towers(cells).collect()), key=str)
    assert got == [(1, 2.0, 3.0), (None, 5.0, 5.0)]


@pytest.mark.parametrize("deflate,bands", [(False, 1), (True, 2)])
def test_raster(spark, tmp_path, deflate, bands):
    grid = np.arange(48.0 * bands).reshape(6, 8, bands)
    grid[2, 3, 0] = np.nan
    (tmp_path / "n33.tif").write_bytes(encode_geotiff(grid, -120.0, 34.0, 1 / 8, 1 / 6, 4, deflate, bands))
    tiles = read_raster_tiles(spark, str(tmp_path))
    assert {r["source"] for r in tiles.collect()} == {"n33"}
    centre = {(round(r[0], 6), round(r[1], 6)): r[2] for r in tiles_to_points(tiles).collect()}
    want = {(round(-120 + (c + 0.5) / 8, 6), round(34 - (r + 0.5) / 6, 6)): grid[r, c, 0] for r in range(6) for c in range(8) if (r, c) != (2, 3)}
    assert centre == want
    thin = read_raster_tiles(spark, str(tmp_path), stride=2)
    corner = tiles_to_points(thin, anchor="corner", names=("longitude", "latitude", "elevation"))
    got = {(round(r[0], 6), round(r[1], 6)): r[2] for r in clean_elevation(corner).collect()}
    assert got == {(round(-120 + c / 8, 6), round(34 - r / 6, 6)): grid[r, c, 0] for r in range(0, 6, 2) for c in range(0, 8, 2)}


def test_raster_bands_come_from_one_reading(spark, tmp_path, monkeypatch):
    grid = np.arange(48.0).reshape(6, 8)
    both = np.stack([grid, -1 - grid], axis=2)
    both[2, 3] = [np.nan, 5.0]
    (tmp_path / "n33.tif").write_bytes(encode_geotiff(both, -120.0, 34.0, 1 / 8, 1 / 6, 2, True, 2))
    points = tiles_to_points(read_raster_bands(spark, str(tmp_path), (1, 0)), names=("x", "y", "second", "first"), bands=("band1", "band0"))
    got = {(round(r["x"], 6), round(r["y"], 6)): (r["first"], r["second"]) for r in points.collect()}
    assert len(got) == 48  # a pixel stays while one of its bands holds a value
    for r in range(6):
        for c in range(8):
            first, second = got[(round(-120 + (c + 0.5) / 8, 6), round(34 - (r + 0.5) / 6, 6))]
            assert second == both[r, c, 1]
            assert first == both[r, c, 0] or (math.isnan(first) and (r, c) == (2, 3))
    # a strip's bytes are read once for both bands
    names = [c.split()[0] for c in geotiff._SEGMENTS.split(", ")]
    strips = [dict(zip(names, s)) for s in geotiff._segments(str(tmp_path / "n33.tif"), (0, 1))]
    reads, opened = [], geotiff._open

    class Counted:
        def __init__(self, path):
            self.file = opened(path)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read_at(self, n, at):
            reads.append(at)
            return self.file.read_at(n, at)

    monkeypatch.setattr(geotiff, "_open", Counted)

    class Batch:
        def to_pylist(self):
            return strips

    assert len(list(geotiff._decode([Batch()], 1, ("band0", "band1")))) == 3
    assert len(reads) == len(set(reads)) == 3


def test_raster_skips_segments_and_reads_either_band(spark, tmp_path):
    grid = np.arange(96.0).reshape(6, 8, 2)
    (tmp_path / "n33.tif").write_bytes(encode_geotiff(grid, -120.0, 34.0, 1 / 8, 1 / 6, 2, True, 2))
    names = [c.split()[0] for c in geotiff._SEGMENTS.split(", ")]
    strips = [dict(zip(names, s)) for s in geotiff._segments(str(tmp_path / "n33.tif"))]
    box = (-119.9, 33.4, -119.0, 33.6)
    assert [s["row0"] for s in strips if geotiff.wanted(s, box, 1)] == [2]
    assert [s["row0"] for s in strips if geotiff.wanted(s, None, 5)] == [0, 4]
    got = tiles_to_points(read_raster_tiles(spark, str(tmp_path), box=box, band=1), box).collect()
    assert sorted(r["pop_cnt"] for r in got) == sorted(grid[r, c, 1] for r in (2, 3) for c in range(8) if -120 + (c + 0.5) / 8 > -119.9)


def test_area_is_linear_in_vertices(spark):
    import time

    def seconds(vertices, rings):
        ring = [[-100 + math.cos(2 * math.pi * i / vertices) / 100, 40 + math.sin(2 * math.pi * i / vertices) / 100] for i in range(vertices)]
        df = spark.createDataFrame([(ring,)], "ring array<array<double>>").crossJoin(spark.range(rings)).coalesce(1).cache()
        df.count()
        run = lambda: df.select(F.sum(ring_area_3395("ring"))).collect()
        run()
        start = time.time()
        run()
        return time.time() - start

    assert seconds(640, 50) < 6 * seconds(10, 3200) + 0.5


def test_csv_folder_matches_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lon,lat,score\n1.0,2.0,3.0\n")
    (tmp_path / "b.csv").write_text("score,lon,lat\n30.0,10.0,20.0\n")
    (tmp_path / "c.csv").write_text("lon,lat\n5.0,6.0\n")
    (tmp_path / "notes.txt").write_text("not a table\n")
    rows = sorted((r["lon"], r["lat"], r["score"]) for r in read_csv_folder(spark, str(tmp_path)).collect())
    assert rows == [(1.0, 2.0, 3.0), (5.0, 6.0, None), (10.0, 20.0, 30.0)]


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    x, y, sizes = rng.normal(size=(7, 3)), rng.normal(size=7), [3, 5, 4, 1]
    v = mlp.initial_vector(sizes, 1)
    for out in ("linear", "sigmoid"):
        loss = lambda w: np.mean((mlp.forward(x, mlp._unpack(w, sizes), out)[-1][:, 0] - y) ** 2)
        slope = [(loss(v + h) - loss(v - h)) / 2e-6 for h in np.eye(len(v)) * 1e-6]
        assert np.allclose(mlp.gradient(x, y, v, sizes, out), slope, atol=1e-6)


def test_net_learns_a_curve(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.random((3000, 2)), columns=["a", "b"])
    pdf["score"] = np.abs(pdf.a - 0.5) + pdf.a * pdf.b
    df = spark.createDataFrame(pdf)
    weights = mlp.mlp_fit(df, ["a", "b"], "score", hidden=(16, 16), epochs=8, partitions=4)
    found = regression_metrics(mlp.mlp_score(df, ["a", "b"], weights, name="p"), "score", "p").first()
    assert found["r2"] > 0.9


def test_regression_and_model_store(spark, tmp_path):
    pdf = pd.DataFrame(np.random.default_rng(0).random((200, 2)), columns=["a", "b"])
    pdf["y"] = 3 * pdf.a - 2 * pdf.b + 1
    df = spark.createDataFrame(pdf)
    save_model(fit_place_model(df, ["a", "b"], "y"), str(tmp_path / "m"))
    found = regression_metrics(load_model(spark, str(tmp_path / "m")).transform(df), "y", "prediction").first()
    assert found["r2"] > 0.999999


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    assert [tuple(r) for r in minmax_scale(df, ["a", "b"]).collect()] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]
    ranges = minmax_ranges(df, ["a"])
    assert minmax_scale(spark.createDataFrame([(5.0,)], "a double"), ["a"], ranges).first()[0] == 2.0
    with pytest.raises(Exception, match="no range for column b"):
        minmax_scale(df, ["a", "b"], ranges).collect()
    scaled = [tuple(r) for r in standard_scale(df, ["a", "b"]).collect()]
    assert scaled[0] == (pytest.approx(-1 / math.sqrt(2)), 0.0) and scaled[2] == (None, 0.0)
    assert [r["x"] for r in normalise_by_max(df, "a", "x").collect()] == [pytest.approx(1 / 3), 1.0, None]


def test_generators(spark):
    lattice = gen_lattice(spark)
    assert lattice.count() == 303_750
    last = lattice.orderBy(F.desc("lon"), F.desc("lat")).first()
    assert tuple(last) == (-125 + 1349 * 0.04, 33 + 224 * 0.04)
    places = gen_places(spark, 500, seed=1)
    assert sorted(places.collect()) == sorted(gen_places(spark, 500, seed=1).collect())
    sides = places.select(F.col("lon2") - F.col("lon1"), F.col("lat2") - F.col("lat1")).collect()
    assert len(sides) == 500 and all(0.5 <= s <= 10 for row in sides for s in row)


def test_chunks_and_split(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("v"), "id")
    chunks = chunk_rows(df, ["v", "id"], 2000).collect()
    want = sorted((r["v"], r["id"]) for r in df.collect())
    assert [c for _, _, c in sorted((r["v"], r["id"], r["chunk"]) for r in chunks)] == [i // 2000 for i in range(len(want))]
    train, test = split_train_test(df, ["id"])
    assert train.count() + test.count() == 5000 and train.join(test, "id").isEmpty()


def test_csv_folder_of_many_files(spark, tmp_path):
    """A thousand files with two headers: the driver meets two header lines, not a thousand paths."""
    for i in range(1000):
        text = f"lon,lat,name\n{i}.5,1,a{i}\n" if i % 2 else f"name,lon\n\nb{i},{i}\n"
        (tmp_path / f"{i}.csv").write_text(("﻿" if i == 1 else "") + text)
    frame = read_csv_folder(spark, str(tmp_path))
    assert dict(frame.dtypes) == {"lon": "double", "lat": "int", "name": "string"}
    rows = {r["name"]: (r["lon"], r["lat"]) for r in frame.collect()}
    assert len(rows) == 1000 and rows["a7"] == (7.5, 1) and rows["b8"] == (8.0, None)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(".csv") <= 2


def test_csv_folder_types_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('day,big,yes,odd name,text\n2024-01-02,5000000000,true,1,"x, y"\n,,,,\n')
    (tmp_path / "b.csv").write_text("big,text\n1,7\n")
    frame = read_csv_folder(spark, str(tmp_path))
    assert dict(frame.dtypes) == {"day": "date", "big": "bigint", "yes": "boolean", "odd name": "int", "text": "string"}
    assert sorted(str(r["text"]) for r in frame.collect()) == ["7", "None", "x, y"]
    given = read_csv_folder(spark, str(tmp_path), StructType([StructField("big", DoubleType()), StructField("day", StringType())]))
    assert sorted(given.columns) == ["big", "day"] and given.agg(F.sum("big")).first()[0] == 5000000001.0
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="no CSV file"):
        read_csv_folder(spark, str(tmp_path / "empty"))


def test_streamed_lists_equal_brute_force(spark, monkeypatch):
    """No pair is shuffled; cut tiles, small buffers, NULL and NaN values, places without neighbours or position."""
    from siteplan.operators import neighbour_pages, radius

    nan = float("nan")
    points = [(0.1 * i, 0.07 * j) for i in range(8) for j in range(5)] + [(0.0, 0.0), (70.0, 70.0), (None, 1.0), (nan, 1.0)]
    others = [(0.013 * (i % 61), 0.017 * (i % 29), [None, nan, float(i)][min(i % 7, 2)]) for i in range(600)] + [(None, 0.0, 1.0)]
    p = spark.createDataFrame(points, "lon double, lat double")
    o = spark.createDataFrame(others, "lon double, lat double, v double")
    plan = radius.neighbour_list(p, o, "v", r=0.1)._jdf.queryExecution().optimizedPlan().toString()
    assert "pairs-" not in plan and "MapInArrow" in plan
    for hot, page in ((radius.LIST_PAIRS, 10_000), (500, 7)):
        found = {}
        for lon, lat, pairs in radius.neighbour_list(p, o, "v", r=0.1, page=page, hot_pairs=hot).collect():
            assert len(pairs) <= page and [q[0] for q in pairs] == sorted(q[0] for q in pairs)
            found.setdefault(str((lon, lat)), []).append(pairs)
        assert set(found) == {str(q) for q in points}
        for lon, lat in points:
            near = [] if lon is None else [[math.sqrt((lon - x) * (lon - x) + (lat - y) * (lat - y)), v] for x, y, v in others if x is not None]
            near = sorted(str(q) for q in near if q[0] < 0.1)
            got = found[str((lon, lat))]
            assert sorted(str(q) for pairs in got for q in pairs) == near
            assert len(got) == 1 if page > 600 else all(got) or len(got) == 1


def test_places_of_one_file_use_all_tasks(spark):
    ids = spark.range(64).coalesce(1).select("id")
    places = gen_places(spark, seed=5, ids=ids)
    assert "Repartition" in places._jdf.queryExecution().optimizedPlan().toString()
    plain = sorted(tuple(row) for row in gen_places(spark, 64, seed=5).collect())
    assert sorted(tuple(row)[1:] for row in places.collect()) == plain
    assert all(0.5 <= x2 - x1 <= 10 and 0.5 <= y2 - y1 <= 10 for x1, y1, x2, y2 in plain)


def test_raster_files_from_listed_pixels(spark, tmp_path):
    """Pixels come as positions and values; no map is searched per pixel, and missing ones are NaN."""
    from siteplan.raster_fixture import write_rasters

    row = [("deg", 0.0, 1.0, 0.5, 0.5, 2, 2, [3, 0], [7.0, None])]
    kinds = "source string, xmin double, ymax double, dx double, dy double, cols int, rows int, at array<int>, values array<double>"
    path = f"file://{tmp_path}/tif"
    assert write_rasters(spark.createDataFrame(row, kinds), path).count() == 1
    (tile,) = read_raster_tiles(spark, path).collect()
    assert [math.isnan(v) for v in tile["band0"][:3]] == [True] * 3 and tile["band0"][3] == 7.0
