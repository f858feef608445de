"""Training and site choice on the features of points: equal to brute force, and nothing stored per disk and cell."""

import math
import uuid
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from siteplan.functions.scoring import DECAY_K
from siteplan.operators.mlp import gradient, initial_vector, step_gradient, training_blocks, weights_table
from siteplan.operators.scale import minmax_scale
from siteplan.plans.points import place_sites, point_features, train_point_model

NAMES, SIZES = ["building_cnt_40d", "elevRank_40d", "pop_40d_sum"], [3, 2, 1]


@pytest.fixture(scope="module")
def dense():
    """Few positions among dense rows, so that a disk's rim meets many cells."""
    draw = np.random.default_rng(8)
    spots = draw.uniform(0, 1, (40, 2)).round(3)
    towers, people, pixels, houses = (draw.uniform(0, 1, (n, 2)) for n in (300, 3000, 3000, 6000))
    return spots, towers, (people, draw.integers(1, 99, 3000) / 4), (pixels, draw.integers(0, 50, 3000) / 2), (houses, draw.integers(1, 99, 6000) / 2)


@pytest.fixture(scope="module")
def wanted(dense):
    spots, towers, (people, heads), (pixels, heights), (houses, _) = dense
    rows = []
    for x, y in spots:
        far = lambda xy: np.sqrt((x - xy[:, 0]) ** 2 + (y - xy[:, 1]) ** 2)
        at, d = far(pixels), far(towers)
        near, n = heights[at < 0.4], max((d < 0.4).sum() - 1, 0)
        rank = (near < heights[at.argmin()]).sum() / (len(near) - 1)
        score = 1 / (2 + 47 * d.min()) + 0.5 * (1 - 1 / math.log(n + 40, 40) ** 2)
        rows.append((x, y, (far(houses) < 0.4).sum(), rank, heads[far(people) < 0.4].sum(), score))
    return pd.DataFrame(rows, columns=["lon", "lat", *NAMES, "score"]).sort_values(["lon", "lat"]).reset_index(drop=True)


def test_training_and_sites_on_dense_rows(spark, dense, wanted, tmp_path, monkeypatch):
    spots, towers, (people, heads), (pixels, heights), (houses, areas) = dense

    def frame(xy, names, *more):
        return spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack([xy, *more])], ", ".join(f"{n} double" for n in names))

    monkeypatch.setattr("siteplan.session.scratch_dir", lambda session, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}")
    found = point_features(
        frame(np.concatenate([spots, spots[:5]]), ["lon", "lat"]),
        frame(towers, ["lon", "lat", "bsid"], np.arange(len(towers))),
        frame(people, ["lon", "lat", "pop_cnt"], heads),
        frame(pixels, ["longitude", "latitude", "elevation"], heights),
        frame(houses, ["center_longitude", "center_latitude", "area"], areas),
        scale=5,
    )
    table = spark.createDataFrame(found.toPandas())
    # the tiles of the four parts, and one row per position for the ranks: no row per disk and cell
    assert sum(spark.read.parquet(f"file://{f}").count() for f in Path(tmp_path).iterdir()) <= 4 * len(spots)

    got = table.toPandas().sort_values(["lon", "lat"]).reset_index(drop=True)
    for c in wanted.columns:
        assert got[c].to_numpy(float) == pytest.approx(wanted[c].to_numpy(float), abs=1e-9), c

    # the gradient and the weights of one step
    x = wanted[NAMES].to_numpy(float)
    x = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
    start = initial_vector(SIZES, 0)
    blocks = training_blocks(minmax_scale(table, NAMES), NAMES, "score")
    slopes = step_gradient(blocks, len(table.toPandas()), start, SIZES)
    assert np.abs(slopes - gradient(x, wanted["score"].to_numpy(float), start, SIZES)).max() < 1e-9
    weights = train_point_model(table, NAMES, hidden=(2,), epochs=1, batches=1)[0]
    assert weights.count() == len(start)

    # the picks, one by one
    net = np.array([0.5, -1.0, 2.0, 1.5, 0.25, -0.5, 0.1, 0.2, 1.0, -0.75, 0.3])
    hidden = np.maximum(x @ net[:6].reshape(2, 3).T + net[6:8], 0)
    score = 1 / (1 + np.exp(-(hidden @ net[8:10] + net[10])))
    sites = place_sites(table, weights_table(spark, net, SIZES), NAMES, n=6).orderBy("pick").collect()
    at = wanted[["lon", "lat"]].to_numpy(float)
    for row in sites:
        best = score.argmax()
        assert (row["lon"], row["lat"]) == tuple(at[best]) and row["score"] == pytest.approx(score[best], abs=1e-9)
        d = np.sqrt(((at - at[best]) ** 2).sum(axis=1))
        score = np.where(d < 0.4, score - DECAY_K / (d * d + DECAY_K), score)
    assert len(sites) == 6
