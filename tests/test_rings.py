"""Centroids and areas of many outlines at once, and the job that stores them."""

import json
import math

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from siteplan.functions.geo import ring_area_3395, ring_centroid
from siteplan.operators.clean import TEST_BOX, TRAIN_BOX
from siteplan.operators.footprints import ring_buildings
from siteplan.plans.inputs import buildings_job
from siteplan.session import scratch_dir

SQUARE = [[-100.0, 40.0], [-99.99, 40.0], [-99.99, 40.01], [-100.0, 40.01], [-100.0, 40.0]]
ODD = [
    SQUARE,
    [[-120.0, 47.0], [-119.9, 47.0], [-119.9, 47.1, 5.0]],
    [[-100.0 + math.cos(i) / 50, 41.0 + math.sin(i) / 50] for i in range(40)],
    [[-80.0, 35.0], [-79.0, 36.0], [-80.0, 35.0]],  # no area
    [[-80.0, 35.0]] * 3,  # one place
    [[-80.0, 35.0]],
    [[-80.0, 35.0], [-79.0, None], [-79.0, 36.0]],
    [[-80.0, 35.0], None, [-79.0, 36.0]],
    [[None, 35.0], [-79.0, 35.5], [-79.0, 36.0]],
    [None, [-79.0, 35.5], [-79.0, 36.0]],
    [[-80.0, 35.0], [-79.0, float("nan")], [-79.0, 36.0]],
    [[-80.0, 35.0], [-79.0, 95.0], [-79.0, 36.0]],  # beyond the pole
    [[10.0, -90.0], [11.0, 0.0], [12.0, 1.0]],
    None,
]


def _close(got, want):
    return got is None if want is None else got is not None and got == pytest.approx(want, rel=1e-9, abs=1e-9, nan_ok=True)


def test_many_rings_equal_the_column_functions(spark):
    rows = [(i, ring) for i, ring in enumerate(ODD)]
    rings = spark.createDataFrame(rows, "id int, ring array<array<double>>")
    want = rings.select("id", ring_centroid("ring").alias("c"), ring_area_3395("ring").alias("a")).collect()
    made = ring_buildings(rings, keep=("id",))
    # functions called per vertex of one ring, several times over, took most of the time
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan
    assert made.columns == ["id", "center_longitude", "center_latitude", "area"]
    got = {r["id"]: r for r in made.coalesce(1).collect()}
    for r in want:
        x, y = (r["c"]["x"], r["c"]["y"]) if r["c"] else (None, None)
        mine = got[r["id"]]
        assert _close(mine["center_longitude"], x) and _close(mine["center_latitude"], y) and _close(mine["area"], r["a"]), r["id"]
    empty = spark.createDataFrame([([],)], "ring array<array<double>>")
    assert tuple(ring_buildings(empty).first()) == (None, None, None)
    with pytest.raises(PythonException, match="less than two coordinates"):
        ring_buildings(spark.createDataFrame([([[1.0, 2.0], [3.0]],)], "ring array<array<double>>")).collect()


def test_boxes_go_by_the_centre(spark):
    rings = spark.createDataFrame([(ring,) for ring in ODD], "ring array<array<double>>")
    every = ring_buildings(rings)
    for boxes in ([TRAIN_BOX], [TRAIN_BOX, TEST_BOX], [TEST_BOX]):
        inside = F.lit(False)
        for west, south, east, north in boxes:
            inside = inside | (F.col("center_longitude").between(west, east) & F.col("center_latitude").between(south, north))
        got = sorted(map(str, ring_buildings(rings, boxes[0] if len(boxes) == 1 else boxes).collect()))
        assert got == sorted(map(str, every.where(inside).collect())) and got
    on_the_edge = spark.createDataFrame([([[-71.0, 42.0]] * 3,)], "ring array<array<double>>")
    assert ring_buildings(on_the_edge, TRAIN_BOX).count() == 1


def test_buildings_of_both_regions_come_from_one_pass(spark, monkeypatch):
    from siteplan.plans import inputs

    passes = []
    monkeypatch.setattr(inputs, "ring_buildings", lambda *a, f=inputs.ring_buildings: passes.append(1) or f(*a))
    path, train, test = (scratch_dir(spark, n) for n in ("outlines", "train", "test"))
    far = [[x + 100.0, y] for x, y in SQUARE]
    for batch, shapes in (("a", [SQUARE, ODD[1], far]), ("b", [SQUARE]), ("b", [SQUARE, SQUARE])):
        lines = [json.dumps({"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [s]}}) for s in shapes]
        spark.createDataFrame([(s,) for s in lines], "value string").write.mode("overwrite").text(path)
        buildings_job(spark, path, train, test, batch=batch)
    assert len(passes) == 3
    assert sorted((r["batch"], round(r["center_longitude"], 6)) for r in spark.read.parquet(train).collect()) == [
        ("a", -99.995), ("b", -99.995), ("b", -99.995)
    ]
    assert [(r["batch"], round(r["center_latitude"], 6)) for r in spark.read.parquet(test).collect()] == [("a", 47.033333)]
    assert spark.read.parquet(train).columns == ["center_longitude", "center_latitude", "area", "batch"]


@pytest.mark.parametrize("lines", [1, 9])
def test_outline_job_over_tiny_tables(spark, tmp_path, lines):
    """A half of the outlines may hold none."""
    from siteplan.queries import QUERIES

    keys = [(k, k % 4 + 1, 7) for k in range(lines)]
    spark.createDataFrame(keys, "l_orderkey bigint, l_linenumber int, l_partkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["job_buildings"](spark, str(tmp_path))
    assert found.count() == sum(1 if n == 1 else 2 for _, n, _ in keys)
