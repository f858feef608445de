"""Disks on quadtrees of several levels: exact whatever the depth, and few rows tested."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siteplan.operators import quadtree, radius
from siteplan.operators.aggregates import count, highest, lowest, total
from siteplan.operators.radius import nearest, nearest_and_count, neighbour_percent_rank, radius_features
from siteplan.operators.range_join import BOUNDS, _border_cells, _outlines, cell_partials, data_grid, range_join

RADII = (0.05, 0.3, 1.0)


def crowded(seed, x0=0.0, y0=0.0):
    draw = random.Random(seed)
    others = [(x0 + draw.gauss(0, 0.4), y0 + draw.gauss(0, 0.4), draw.choice([None, 1.0, 2.5, 4.0])) for _ in range(900)]
    others += [(x0 + 0.25, y0 + 0.25, 3.0)] * 200 + [(x0 + draw.uniform(-4, 4), y0 + draw.uniform(-4, 4), 1.5) for _ in range(60)]
    others += [(None, y0, 1.0), (float("nan"), y0, 1.0)]
    points = [(x0 + draw.uniform(-2, 2), y0 + draw.uniform(-2, 2)) for _ in range(25)] + [(x0 + 0.25, y0 + 0.25)] * 2
    points += [(x0 + 9.0, y0), (None, y0)]
    return points, others


def found(point, others, r):
    if point[0] is None:
        return []
    rows = [(math.sqrt((point[0] - x) ** 2 + (point[1] - y) ** 2), x, y, v) for x, y, v in others if x is not None and not math.isnan(x)]
    return [row for row in rows if row[0] < r]


@pytest.mark.parametrize("crowd, x0, y0", [(4, 0.0, 0.0), (40, -125.0, 4e6)])
def test_features_on_many_levels(spark, crowd, x0, y0):
    points, others = crowded(3, x0, y0)
    p, o = spark.createDataFrame(points, "lon double, lat double"), spark.createDataFrame(others, "lon double, lat double, v double")
    tree = quadtree.grow(o, ("lon", "lat"), RADII, [], [], crowd)
    assert tree.levels >= 2 and tree.rows.count() == len(others) - 2
    aggs = {"c_{}": count(), "k_{}": count("v"), "s_{}": total("v", 3), "lo_{}": lowest("v"), "hi_{}": highest("v")}
    rows = radius_features(p, o, aggs, RADII, crowd=crowd, least="d").collect()
    assert len(rows) == len(points)
    for row in rows:
        for i, name in ((0.05, "5d"), (0.3, "30d"), (1.0, "100d")):
            near = found(tuple(row[:2]), others, i)
            vs = [v for *_, v in near if v is not None]
            want = (len(near), len(vs), round(sum(vs), 3) if vs else None, min(vs, default=None), max(vs, default=None))
            got = tuple(row[f"{a}_{name}"] for a in ("c", "k", "s", "lo", "hi"))
            assert got[:2] == want[:2] and got[3:] == want[3:]
            assert got[2] is None if want[2] is None else abs(got[2] - want[2]) < 1e-9
        near = found(tuple(row[:2]), others, 1.0)
        assert row["d"] == (min(near)[0] if near else None)
    best = {(r["lon"], r["lat"]): r for r in nearest(p, o, 1.0, keep=("v",), crowd=crowd).collect()}
    for point in points:
        near = found(point, others, 1.0)
        if near:
            assert best[point]["dist"] == min(d for d, *_ in near)
        else:
            assert point not in best


def test_percent_rank_on_many_levels(spark):
    points, others = crowded(5)
    p, o = spark.createDataFrame(points, "lon double, lat double"), spark.createDataFrame(others, "lon double, lat double, v double")
    for row in neighbour_percent_rank(p, o, "v", RADII, "r_{}", pixel_xy=("lon", "lat"), crowd=4).collect():
        near = found(tuple(row[:2]), others, 1.0)
        order = lambda v: (v is not None, v or 0.0)
        chosen = min(near, key=lambda n: (n[0], n[1], n[2], order(n[3])), default=None)
        for r, name in ((0.05, "5d"), (0.3, "30d"), (1.0, "100d")):
            inside = [n for n in near if n[0] < r]
            if chosen is None or chosen[0] >= r or len(inside) < 2:
                assert row[f"r_{name}"] == 0.0
            else:
                less = sum(order(n[3]) < order(chosen[3]) for n in inside)
                assert abs(row[f"r_{name}"] - less / (len(inside) - 1)) < 1e-12


def test_few_rows_are_tested_in_dense_data(spark):
    """Of the rows in a disk at most a fifth is tested one by one, at every radius of the features."""
    radii = (0.01, 0.1, 0.4)
    others = spark.range(400_000).select((F.rand(1) * 2).alias("lon"), (F.rand(2) * 2).alias("lat"))
    draw = random.Random(8)
    spots = [(draw.uniform(0.5, 1.5), draw.uniform(0.5, 1.5)) for _ in range(20)]
    points = spark.createDataFrame(spots, "lon double, lat double")
    tree = quadtree.grow(others, ("lon", "lat"), radii, [], [], crowd=32)
    cut = (F.col("near") < 0.01) & (F.col("far") >= 0.01)
    for r in radii[1:]:
        cut = cut | ((F.col("near") < r) & (F.col("far") >= r))
    whole, tested = quadtree.walk(tree, points, ("lon", "lat"), radii[-1], cut)
    tests = tested.join(tree.sizes(), ["k", "gx", "gy"]).agg(F.sum("n_r")).first()[0]
    taken = whole.agg(F.sum("n_r"), F.count("*")).first()
    inside = 400_000 / 4 * math.pi * 0.16 * len(spots)
    assert tests <= 0.2 * inside
    assert abs(taken[0] + tests - inside) < 0.2 * inside and taken[1] / len(spots) < 600


def test_towers_are_read_once_for_count_and_distance(spark, tmp_path):
    """Only the cells' own pass and the tested rows read the towers: no second tree for the distance."""
    spark.range(2000).select((F.col("id") % 50 / 10).alias("lon"), (F.col("id") / 400).alias("lat")).write.parquet(f"file://{tmp_path}/t")
    towers = spark.read.parquet(f"file://{tmp_path}/t")
    points = spark.createDataFrame([(1.0, 1.0), (3.3, 2.0)], "lon double, lat double")
    out = nearest_and_count(points, towers, 0.5, exact_n=True)
    scans = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line and "lat" in line]
    others = [line for line in scans if "gx" not in line]
    assert len(others) == 1
    assert out.count() == 2


# --- grids of the range join -------------------------------------------------------------


@pytest.mark.parametrize("strict", [True, False])
def test_rectangles_in_metres_test_few_points(spark, strict):
    """Default arguments, coordinates far from zero and in clusters: few points are tested one by one."""
    draw = random.Random(6)
    towns = [(500_000 + draw.uniform(-2e5, 2e5), 4_100_000 + draw.uniform(-3e5, 3e5)) for _ in range(12)]
    spots = [(x + draw.gauss(0, 4e3), y + draw.gauss(0, 4e3)) for x, y in (draw.choice(towns) for _ in range(30_000))]
    spots += [(9e9, 1.0), (1.0, -9e9), (float("inf"), 0.0), (None, 2.0)]
    shapes = []
    for _ in range(60):
        x, y = draw.choice(towns)
        a, b = x - draw.uniform(0, 3e4), y - draw.uniform(0, 3e4)
        shapes.append((a, b, a + draw.uniform(1e3, 8e4), b + draw.uniform(1e3, 8e4)))
    shapes += [(spots[0][0], spots[0][1], spots[1][0], spots[1][1]), (spots[5][0], spots[5][1], spots[5][0], spots[5][1])]
    rects = spark.createDataFrame(shapes, list(BOUNDS))
    pts = spark.createDataFrame(spots, "lon double, lat double").repartition(6)
    inside = (lambda a, lo, hi: lo < a < hi) if strict else (lambda a, lo, hi: lo <= a <= hi)
    hits = {}
    for row in range_join(rects, pts, ("lon", "lat"), {"n": count("lon")}, strict=strict).collect():
        want = sum(x is not None and inside(x, row[0], row[2]) and inside(y, row[1], row[3]) for x, y in spots)
        assert row["n"] == want
        hits[tuple(row[:4])] = want
    grid = data_grid(pts, ("lon", "lat"))
    cells = cell_partials(pts, ("lon", "lat"), {"n": count()}, grid).cache()
    edges = tuple(cells.agg(F.min("gx"), F.max("gx"), F.min("gy"), F.max("gy")).first())
    outline = _border_cells(_outlines(rects, BOUNDS, grid, edges)).join(cells, ["gx", "gy"])
    # of all points for all rectangles, which are tested when the points share one cell
    share = outline.agg(F.sum("n_rows")).first()[0] / (len(shapes) * len(spots))
    assert share < 0.1, share


def test_grid_index_is_monotone(spark):
    values = sorted([0.0, -0.0, 1e-300, 5.0, 5.0, 5.0000001, 7.5, 1e308, -1e308, 3.3] + [random.Random(2).gauss(0, 1) for _ in range(500)])
    frame = spark.createDataFrame([(v, v) for v in values], "x double, y double")
    grid = data_grid(frame, ("x", "y"))
    rows = frame.select("x", grid.index(0, F.col("x")).alias("g")).orderBy("x").collect()
    assert [r["g"] for r in rows] == sorted(r["g"] for r in rows) and len({r["g"] for r in rows}) > 4
    empty = data_grid(frame.limit(0), ("x", "y"))
    assert frame.select(empty.index(1, F.col("y"))).distinct().count() == 1


def test_neighbour_lists_come_in_pages(spark):
    # a million neighbours around one point, a hundred thousand of them the same row, and a lonely point
    near = spark.range(900_000).select(
        (F.col("id") % 977 / 5000).alias("lon"), (F.col("id") % 991 / 5000).alias("lat"), F.col("id").cast("double").alias("area")
    )
    same = spark.range(100_000).select(F.lit(0.05).alias("lon"), F.lit(0.05).alias("lat"), F.lit(1.0).alias("area"))
    points = spark.createDataFrame([(0.1, 0.1), (50.0, 50.0)], "lon double, lat double")
    lists = radius.neighbour_list(points, near.union(same), "area", page=10_000)
    got = lists.groupBy("lon").agg(
        F.sum(F.size("neighbours")).alias("n"), F.max(F.size("neighbours")).alias("longest"), F.count("*").alias("rows"),
        F.sum(F.aggregate("neighbours", F.lit(0.0), lambda s, p: s + p[1])).alias("area"),
    ).orderBy("lon").collect()
    assert [(r["n"], r["longest"]) for r in got] == [(1_000_000, 10_000), (0, 0)]
    # whole pages, save one per task
    assert got[0]["rows"] <= 100 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert got[0]["area"] == 899_999 * 900_000 / 2 + 100_000
