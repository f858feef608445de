"""Disks in tiles: equal to brute force, and in time of their strips."""

import math
import random
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from siteplan.operators.aggregates import count, total
from siteplan.operators.grid import tile_groups
from siteplan.operators.radius import neighbour_percent_rank, radius_features
from siteplan.operators.tile_disks import Ranks, Tile, disk_ranks, disk_sums, nearest_values, ordered

RADII = (0.1, 0.4)


def clusters(seed, n=700):
    draw = np.random.default_rng(seed)
    x = np.concatenate([draw.normal(0, 0.01, n), draw.uniform(-1, 1, n), np.full(n, 0.3), np.arange(40) / 10 - 2])
    y = np.concatenate([draw.normal(0, 0.01, n), draw.uniform(-1, 1, n), np.full(n, 0.3), np.full(40, 0.5)])
    v = draw.integers(0, 9, len(x)).astype(float)
    px, py = draw.uniform(-1.5, 1.5, 60).tolist() + [0.3, 0.0, 0.5], draw.uniform(-1.5, 1.5, 60).tolist() + [0.3, 0.0, 0.5]
    return np.array(px), np.array(py), x, y, v


@pytest.mark.parametrize("seed, far", [(1, 0.0), (2, 4e6), (3, -1e15)])
def test_disks_equal_brute_force(seed, far):
    px, py, x, y, v = clusters(seed)
    px, x = px + far, x + far
    none = np.arange(len(v)) % 7 == 0
    values = pa.array([None if n else (float("nan") if w == 8 else w) for n, w in zip(none, v)])
    rows = pa.table({"x": x, "y": y, "v": values, "p": pa.array(np.where(none, 0, v * 2.0**40).astype(np.int64), mask=none)})
    spots = pa.table({"x": px, "y": py})
    sums = {(r["x"], r["y"]): r for r in disk_sums(spots, rows, RADII, ["p"], [pa.int64()], True).to_pylist()}
    chosen = nearest_values(spots, rows, RADII[-1], pa.float64())
    near = {(r["x"], r["y"]): r for r in chosen.to_pylist()}
    asked = chosen.select(["x", "y", "v"]).rename_columns(["x", "y", "v0"])
    ranked = {(r["x"], r["y"]): r for r in disk_ranks(asked, rows, RADII).to_pylist()}
    key = lambda w: (w is not None, w is not None and math.isnan(w), 0.0 if w is None or math.isnan(w) else w)
    vs, ps = rows["v"].to_pylist(), rows["p"].to_pylist()
    for a, b in zip(px.tolist(), py.tolist()):
        d = np.sqrt((a - x) ** 2 + (b - y) ** 2)
        inside = np.flatnonzero(d < RADII[-1])
        assert ((a, b) in sums) == ((a, b) in near) == ((a, b) in ranked) == (len(inside) > 0)
        if not len(inside):
            continue
        best = min(inside, key=lambda i: (d[i], x[i], y[i], key(vs[i])))
        assert sums[a, b]["d"] == near[a, b]["dist"] == d[best]
        assert (near[a, b]["nb_x"], near[a, b]["nb_y"], key(near[a, b]["v"])) == (x[best], y[best], key(vs[best]))
        for i, r in enumerate(RADII):
            within = np.flatnonzero(d < r)
            known = [ps[k] for k in within if ps[k] is not None]
            assert sums[a, b][f"p_{i}"] == (sum(known) if known else None)
            less = sum(key(vs[k]) < key(vs[best]) for k in within)
            assert (ranked[a, b][f"n_{i}"], ranked[a, b][f"less_{i}"]) == (len(within), less)


def test_few_spots_are_tested():
    draw = np.random.default_rng(4)
    tile = Tile(draw.uniform(0, 2, 300_000), draw.uniform(0, 2, 300_000))
    px, py = draw.uniform(0.5, 1.5, 50), draw.uniform(0.5, 1.5, 50)
    for r in (0.1, 0.4):
        found = [v for *_, v in tile.covers(px, py, np.full(50, r))]
        strips = sum(len(a) for a, *_ in found) / 50
        tested = sum(int((b - a + d - c).sum()) for a, b, c, d in found) / 50
        rows = 300_000 / 4 * math.pi * r * r
        assert strips < 2 * math.sqrt(rows) and tested < 20 * math.sqrt(rows)


def test_ranks_and_orders():
    rank = np.random.default_rng(5).permutation(33)
    ranks = Ranks(rank)
    for a, b, k in [(0, 33, 33), (0, 33, 0), (5, 20, 11), (7, 7, 9), (32, 33, 32)]:
        assert ranks.below(np.array([a]), np.array([b]), np.array([k]))[0] == (rank[a:b] < k).sum()
    assert ordered(pa.chunked_array([[2.0, None, float("nan")], [1.0, 2.0, -0.0]])).tolist() == [3, 0, 5, 2, 3, 1]
    assert ordered(pa.chunked_array([["b", None, "a", "b"]])).tolist() == [2, 0, 1, 2]


def test_cut_tiles_store_no_cover(spark, tmp_path, monkeypatch):
    """Dense rows in cut tiles: right, and nothing is stored per position and cell."""
    draw = random.Random(6)
    others = [(draw.uniform(0, 1), draw.uniform(0, 1), draw.choice([None, 1.25, 2.5])) for _ in range(6000)]
    points = [(draw.uniform(0, 1), draw.uniform(0, 1)) for _ in range(30)] + [(0.5, 0.5)] * 2 + [(None, 0.5), (50.0, 0.5)]
    p, o = spark.createDataFrame(points, "lon double, lat double"), spark.createDataFrame(others, "lon double, lat double, v double")
    monkeypatch.setattr("siteplan.session.scratch_dir", lambda session, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}")
    rows = radius_features(p, o, {"c_{}": count(), "s_{}": total("v", 2)}, RADII, least="d", tile_rows=900).collect()
    ranks = {tuple(r[:2]): r for r in neighbour_percent_rank(p, o, "v", RADII, "r_{}", pixel_xy=("lon", "lat"), tile_rows=900).collect()}
    stored = [spark.read.parquet(f"file://{f}").count() for f in Path(tmp_path).iterdir()]
    # tiles, and one row per position for the ranks
    assert len(stored) == 4 and sum(stored) <= 2 * len(points)
    assert len(rows) == len(points)
    order = lambda v: (v is not None, v or 0.0)
    for row in rows:
        x, y = row["lon"], row["lat"]
        near = sorted(((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), a, b, v) for a, b, v in others), key=lambda n: n[:3]) if x is not None else []
        near = [n for n in near if n[0] < 0.4]
        assert row["d"] == (near[0][0] if near else None)
        for r, name in ((0.1, "10d"), (0.4, "40d")):
            inside = [n for n in near if n[0] < r]
            known = [n[3] for n in inside if n[3] is not None]
            assert (row[f"c_{name}"], row[f"s_{name}"]) == (len(inside), sum(known) if known else None)
            want = sum(order(n[3]) < order(near[0][3]) for n in inside) / (len(inside) - 1) if len(inside) > 1 else 0.0
            assert ranks[x, y][f"r_{name}"] == pytest.approx(want, abs=1e-12)


def test_tiles_are_dealt_to_all_tasks(spark):
    # 256 tiles of few bytes, which adaptive execution would merge for one task
    keys = [(x, y) for x in range(16) for y in range(16)]
    left, right = (spark.createDataFrame([(*k, float(i)) for i, k in enumerate(keys)], f"gx long, gy long, {c} double") for c in "ab")

    def where(a, b):
        return pa.table({"task": [TaskContext.get().partitionId()], "same": [int(a["a"].to_pylist() == b["b"].to_pylist())]})

    met = tile_groups(left, right, ["gx", "gy"], right.groupBy("gx", "gy").agg(F.count("*").alias("n_r")), 100)
    rows = met.applyInArrow(where, "task long, same long").collect()
    assert len(rows) == len(keys) and all(r["same"] for r in rows)
    assert len({r["task"] for r in rows}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_positions_are_visited_from_neighbour_to_neighbour():
    draw = np.random.default_rng(9)
    x, y, v = draw.uniform(0, 1, 20_000), draw.uniform(0, 1, 20_000), draw.integers(0, 99, 20_000).astype(float)
    px, py = draw.uniform(0, 1, 3_000), draw.uniform(0, 1, 3_000)
    spots, rows = pa.table({"x": px, "y": py}), pa.table({"x": x, "y": y, "v": v, "p": v.astype(np.int64)})
    chosen = nearest_values(spots, rows, 0.2, pa.float64())
    asked = chosen.select(["x", "y", "v"]).rename_columns(["x", "y", "v0"])
    for found in (disk_sums(spots, rows, (0.05, 0.2), ["p"], [pa.int64()], True), chosen, disk_ranks(asked, rows, (0.05, 0.2))):
        a, b = np.asarray(found["x"]), np.asarray(found["y"])
        assert sorted(zip(a, b)) == sorted(zip(px, py))
        # random positions of the unit square lie 0.52 apart on average
        assert np.hypot(np.diff(a), np.diff(b)).mean() < 0.15
