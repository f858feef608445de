"""Grid joins against brute force, with points on bounds, copies, and crowded cells."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siteplan.operators.aggregates import count, deviation, highest, lowest, mean, total
from siteplan.operators.grid import cell_join
from siteplan.operators.radius import nearest, nearest_and_count, neighbour_percent_rank, radius_features, radius_join
from siteplan.operators.range_join import BOUNDS, cell_partials, range_join

HOT = (10**8, 3)


def make(seed):
    rng = random.Random(seed)
    rects = [tuple([a := round(rng.uniform(-3, 3), 1), b := round(rng.uniform(-3, 3), 1), a + rng.choice([0.0, 0.3, 1.0, 4.7]), b + rng.choice([0.1, 0.5, 2.6])]) for _ in range(40)]
    rects += rects[:5]  # copies of places
    pts = [(round(rng.uniform(-3, 5), 1), round(rng.uniform(-3, 5), 2), rng.choice([None, 1.5, 2.0, 7.25])) for _ in range(300)]
    pts += [(r[0], r[1], 1.0) for r in rects[:10]] + [(r[2], r[3], 2.0) for r in rects[:10]]  # on the corners
    pts += [(0.15, 0.15, 4.0)] * 150  # a third of the rows at one spot
    pts += [(None, 1.0, 1.0), (float("nan"), 0.0, 1.0)]
    return rects, pts


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("strict", [True, False])
def test_range_join(spark, hot, strict):
    rects, pts = make(3)
    r = spark.createDataFrame(rects, list(BOUNDS))
    p = spark.createDataFrame(pts, "lon double, lat double, v double")
    aggs = {"n": count("lon"), "k": count("v"), "s": total("v", 3), "m": mean("v", 3), "d": deviation("v", 3), "lo": lowest("v"), "hi": highest("v")}
    got = {}
    for row in range_join(r, p, ("lon", "lat"), aggs, strict=strict, hot_pairs=hot).collect():
        got.setdefault(tuple(row[:4]), []).append(row)
    assert sum(map(len, got.values())) == len(rects)
    for x1, y1, x2, y2 in rects:
        inside = (lambda a, lo, hi: lo < a < hi) if strict else (lambda a, lo, hi: lo <= a <= hi)
        hits = [v for x, y, v in pts if x is not None and inside(x, x1, x2) and inside(y, y1, y2)]
        vals = [v for v in hits if v is not None]
        row = got[(x1, y1, x2, y2)][0]
        assert (row["n"], row["k"]) == (len(hits), len(vals))
        assert row["s"] == (sum(vals) if vals else None)
        assert row["lo"] == (min(vals) if vals else None) and row["hi"] == (max(vals) if vals else None)
        if len(vals) > 1:
            m = sum(vals) / len(vals)
            assert row["m"] == pytest.approx(m)
            assert row["d"] == pytest.approx(math.sqrt(sum((v - m) ** 2 for v in vals) / (len(vals) - 1)), abs=1e-9)
        else:
            assert row["d"] is None


def test_inner_join_and_stored_cells(spark):
    rects, pts = make(4)
    r = spark.createDataFrame(rects, list(BOUNDS))
    p = spark.createDataFrame(pts, "lon double, lat double, v double")
    aggs = {"n": count("v")}
    cells = cell_partials(p, ("lon", "lat"), aggs, 0.2)
    left = range_join(r, p, ("lon", "lat"), aggs, cells=cells).where("n > 0").collect()
    inner = range_join(r, p, ("lon", "lat"), aggs, how="inner").where("n > 0").collect()
    assert sorted(left) == sorted(inner)


def test_cell_join_keeps_every_pair(spark):
    left = spark.createDataFrame([(1, i % 4) for i in range(40)] + [(2, 9)], "k int, a int").repartition(3)
    right = spark.createDataFrame([(1, i % 3) for i in range(50)] + [(2, 5), (3, 1)], "k int, b int").repartition(2)
    want = sorted(left.join(right, "k").select("k", "a", "b").collect())
    joined = cell_join(left, right, ["k"], hot_pairs=20)
    assert sorted(joined.select("k", "a", "b").collect()) == want
    assert "own_parts_l" in joined._jdf.queryExecution().toString()  # both sides of the crowded key are cut


def test_open_bounds_and_far_points(spark):
    inf = float("inf")
    rects = [(0.0, 0.0, inf, 1.0), (-inf, -inf, inf, inf), (0.0, 0.0, 1e15, 1e15), (50.0, 50.0, 60.0, 60.0)]
    pts = [(0.5, 0.5, 1.0), (1e14, 0.5, 2.0), (-1e13, -5.0, 4.0), (inf, 0.5, 8.0)]
    r = spark.createDataFrame(rects, list(BOUNDS))
    p = spark.createDataFrame(pts, "lon double, lat double, v double")
    found = range_join(r, p, ("lon", "lat"), {"s": total("v")}).collect()
    assert {tuple(f)[:4]: f["s"] for f in found} == {rects[0]: 3.0, rects[1]: 7.0, rects[2]: 3.0, rects[3]: None}


def test_deviation_far_from_zero(spark):
    pts = [(0.5, 0.5, 1e8 + 0.01 * (i % 2)) for i in range(1000)]
    p = spark.createDataFrame(pts, "lon double, lat double, v double")
    r = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0)], list(BOUNDS))
    want = p.selectExpr("stddev_samp(v)").first()[0]
    for scale in (None, 5):
        got = range_join(r, p, ("lon", "lat"), {"d": deviation("v", scale)}).first()["d"]
        assert got == pytest.approx(want, rel=1e-5)


def test_points_are_read_twice_at_most(spark, tmp_path):
    rects, pts = make(5)
    path = str(tmp_path / "pts")
    spark.createDataFrame(pts, "lon double, lat double, v double").write.parquet(path)
    r = spark.createDataFrame(rects, list(BOUNDS))
    joined = range_join(r, spark.read.parquet(path), ("lon", "lat"), {"s": total("v")})
    assert joined._jdf.queryExecution().executedPlan().toString().count(path.rsplit("/", 1)[-1] + "]") <= 1  # and once for the cells


@pytest.mark.parametrize("hot", HOT)
def test_radius_operators(spark, hot):
    rng = random.Random(8)
    points = [(-1 + 0.04 * i, 2 + 0.04 * j) for i in range(12) for j in range(4)]
    others = [(-1 + 0.04 * rng.randrange(30), 2 + 0.04 * rng.randrange(25), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(200)]
    others += [(-0.9, 2.05, 2.0)] * 100
    p = spark.createDataFrame(points, "lon double, lat double")
    o = spark.createDataFrame(others, "lon double, lat double, v double")
    radii = (0.03, 0.2, 0.4)
    dist = lambda a, b: math.sqrt((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]))

    rows = radius_features(p, o, {"c_{}": count(), "s_{}": total("v", 3)}, radii, hot_pairs=hot).collect()
    assert len(rows) == len(points)
    for row in rows:
        for r, name in zip(radii, ("3d", "20d", "40d")):
            near = [b[2] for b in others if dist(row, b) < r]
            vals = [v for v in near if v is not None]
            assert row[f"c_{name}"] == len(near)
            assert row[f"s_{name}"] == (sum(vals) if vals else None)

    best = {(r["lon"], r["lat"]): r for r in nearest(p, o, 0.4, keep=("v",), hot_pairs=hot).collect()}
    for a in points:
        near = [dist(a, b) for b in others if dist(a, b) < 0.4]
        assert (best[a]["dist"] if a in best else None) == (min(near) if near else None)

    for row in nearest_and_count(p, o, 0.2, hot_pairs=hot).collect():
        near = [dist(row, b) for b in others if dist(row, b) < 0.2]
        assert row["n"] == max(len(near) - 1, 0)
        assert row["d"] == (min(near) if near else None)

    pairs = radius_join(p, o, 0.2, keep=("v",), how="inner", hot_pairs=hot).count()
    assert pairs == sum(dist(a, b) < 0.2 for a in points for b in others)

    none = (99, 99, 99)
    for row in neighbour_percent_rank(p, o, "v", radii, "r_{}", pixel_xy=("lon", "lat"), hot_pairs=hot).collect():
        for r, name in zip(radii, ("3d", "20d", "40d")):
            near = [b for b in others if dist(row, b) < r]
            key = lambda b: (dist(row, b), b[0], b[1], b[2] is not None, b[2] or 0)
            want = 0.0
            if len(near) > 1:
                v = min(near, key=key)[2]
                less = 0 if v is None else sum(b[2] is None or b[2] < v for b in near)
                want = less / (len(near) - 1)
            assert row[f"r_{name}"] == want, none


@pytest.mark.parametrize("x0, y0, r", [(-125.0, 40.0, 0.01), (500_000.0, 4_100_000.0, 400.0), (3e15, -7e15, 0.4), (1e300, -5.0, 0.01)])
def test_radius_operators_far_from_zero(spark, x0, y0, r):
    rng = random.Random(5)
    place = lambda: (x0 + rng.uniform(-2, 2) * r, y0 + rng.uniform(-2, 2) * r)
    points, others = [place() for _ in range(30)], [(*place(), float(i)) for i in range(120)]
    p = spark.createDataFrame(points, "lon double, lat double")
    o = spark.createDataFrame([*others, (float("inf"), y0, -1.0), (x0, float("-inf"), -1.0)], "lon double, lat double, v double")
    dist = lambda a, b: math.sqrt((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]))
    near = {a: [b for b in others if dist(a, b) < r] for a in points}
    assert any(near.values())
    for row in radius_features(p, o, {"c_{}": count(), "s_{}": total("v", 3)}, (r / 2, r)).collect():
        sums = [[b[2] for b in near[row[:2]] if dist(row, b) < d] for d in (r / 2, r)]
        assert list(row[2:]) == [x for vals in sums for x in (len(vals), sum(vals) if vals else None)]
    for row in nearest_and_count(p, o, r, exact_n=True).collect():
        hits = near[row[:2]]
        assert (row["n"], row["d"]) == (len(hits), min((dist(row, b) for b in hits), default=None))
    assert radius_join(p, o, r, how="inner").count() == sum(map(len, (near[a] for a in points)))


@pytest.mark.parametrize("strict", [True, False])
def test_tiles_cut_into_parts(spark, strict):
    """Tiles with more points and rectangles than fit a group, sums beyond 64 bits, negative values, all-NULL rectangles."""
    rng = random.Random(12)
    value = lambda: rng.choice([None, rng.randrange(-(10**17), 10**17), 10**17])
    pts = [(round(rng.uniform(0, 4), 1), round(rng.uniform(0, 4), 1), value()) for _ in range(400)] + [(9.0, 9.0, None)] * 3
    rects = [tuple([a := round(rng.uniform(0, 3), 1), b := round(rng.uniform(0, 3), 1), a + rng.uniform(0, 2), b + 0.5]) for _ in range(60)]
    rects += [(8.5, 8.5, 9.0, 9.5), (8.5, 8.5, 9.5, 9.5), (2.0, 2.0, 1.0, 1.0), (None, 0.0, 1.0, 1.0)]
    p = spark.createDataFrame(pts, "lon double, lat double, v bigint").withColumn("v", F.expr("CAST(v AS DECIMAL(18,0))"))
    r = spark.createDataFrame(rects, "lon1 double, lat1 double, lon2 double, lat2 double")
    aggs = {"n": count(), "k": count("v"), "s": total("v", 0), "m": mean("v", 0), "d": deviation("v", 0)}
    inside = (lambda a, lo, hi: lo < a < hi) if strict else (lambda a, lo, hi: lo <= a <= hi)
    rows = range_join(r, p, ("lon", "lat"), aggs, strict=strict, tile_rows=50).collect()
    assert len(rows) == len(rects)
    for row in rows:
        x1, y1, x2, y2 = row[:4]
        vals = [v for x, y, v in pts if x1 is not None and inside(x, x1, x2) and inside(y, y1, y2)]
        known = [v for v in vals if v is not None]
        assert (row["n"], row["k"], row["s"]) == (len(vals), len(known), float(sum(known)) if known else None)
        assert row["m"] == (float(sum(known)) / len(known) if known else None)
        if len(known) > 1:
            mean_ = sum(known) / len(known)
            assert row["d"] == pytest.approx(math.sqrt(sum((v - mean_) ** 2 for v in known) / (len(known) - 1)))


def test_rectangles_meet_few_tiles(spark):
    """Ten times the points give a rectangle no more cells at its outline."""
    rects = spark.createDataFrame([(0.1, 0.1, 0.6, 0.7)], list(BOUNDS))
    for n in (4_000, 40_000):
        pts = spark.range(n).selectExpr("pmod(id * 7919, 10007) / 10007 AS lon", "pmod(id * 104729, 9973) / 9973 AS lat", "id AS v")
        joined = range_join(rects, pts, ("lon", "lat"), {"s": total("v", 0), "n": count()})
        assert "FlatMapCoGroupsInArrow" in joined._jdf.queryExecution().executedPlan().toString()
        want = pts.where("lon > 0.1 AND lon < 0.6 AND lat > 0.1 AND lat < 0.7").selectExpr("double(sum(v))", "count(*)").first()
        assert tuple(joined.first()[-2:]) == tuple(want)
