"""Synchronous training and regression from sums: the same under every partitioning, and right."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siteplan.operators import mlp
from siteplan.operators.layout import split_train_test
from siteplan.operators.regression import INTERCEPT, fit_normal, fit_place_model, predict, regression_metrics


@pytest.fixture(scope="module")
def curve(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.random((3000, 2)), columns=["a", "b"])
    pdf["score"] = np.abs(pdf.a - 0.5) + pdf.a * pdf.b
    pdf["id"] = np.arange(3000)
    return spark.createDataFrame(pd.concat([pdf, pdf.head(900), pdf.head(1).loc[[0] * 800]]))


def values(weights):
    return [r["value"] for r in weights.orderBy("layer", "i", "j").collect()]


def test_same_weights_under_every_partitioning(curve, monkeypatch):
    monkeypatch.setattr(mlp, "BLOCK_ROWS", 200)
    found = [
        values(mlp.mlp_descend(curve.repartition(parts), ["a", "b"], "score", hidden=(8, 4), epochs=2, batches=3))
        for parts in (1, 4, 16)
    ]
    assert found[0] == found[1] == found[2]


def test_step_is_the_gradient_over_all_rows(curve, monkeypatch):
    monkeypatch.setattr(mlp, "BLOCK_ROWS", 100)
    sizes = [2, 6, 1]
    vector = mlp.initial_vector(sizes, 4)
    pdf = curve.toPandas()
    want = mlp.gradient(pdf[["a", "b"]].to_numpy(), pdf["score"].to_numpy(), vector, sizes)
    blocks = mlp.training_blocks(curve, ["a", "b"], "score", batches=4)
    got = mlp.step_gradient(blocks, len(pdf), vector, sizes)
    assert np.abs(got - want).max() < 1e-9
    most = blocks.agg(F.max(F.size("y")), F.sum(F.aggregate("times", F.lit(0.0), lambda a, b: a + b))).first()
    assert most[0] < 200 and most[1] == len(pdf)  # 800 copies of one row fill no block


def test_loss_on_held_back_rows(curve, monkeypatch):
    monkeypatch.setattr(mlp, "BLOCK_ROWS", 400)
    train, held = split_train_test(curve, ["id"])
    weights = mlp.mlp_descend(train, ["a", "b"], "score", hidden=(16, 16), epochs=15, batches=8, lr=0.02)
    found = regression_metrics(mlp.mlp_score(held, ["a", "b"], weights, name="p"), "score", "p").first()
    assert found["r2"] > 0.9 and found["mse"] < 0.01


def test_training_skips_incomplete_rows(spark):
    rows = [(1.0, 2.0, 3.0), (None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (2.0, 1.0, None), (0.0, 0.0, 1.0)]
    frame = spark.createDataFrame(rows, "a double, b double, y double")
    whole = mlp.mlp_descend(frame, ["a", "b"], "y", hidden=(3,), epochs=2)
    assert values(whole) == values(mlp.mlp_descend(frame.na.drop(), ["a", "b"], "y", hidden=(3,), epochs=2))
    with pytest.raises(ValueError, match="no complete rows"):
        mlp.mlp_descend(frame.limit(0), ["a", "b"], "y", hidden=(3,), epochs=1)


def test_regression_from_sums(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(500, 3)) * [1, 1000, 0.01] + [5, 1e6, 0], columns=["a", "b", "c"])
    pdf["same"] = 4.0
    pdf["y"] = 3 * pdf.a - 0.02 * pdf.b + 50 * pdf.c + rng.normal(size=500)
    df = spark.createDataFrame(pdf)
    names = ["a", "b", "c", "same"]
    models = [{r["feature"]: r for r in fit_normal(df.repartition(n), names, "y").collect()} for n in (1, 4, 16)]
    design = np.column_stack([(pdf[n] - pdf[n].mean()) / pdf[n].std() for n in names[:3]] + [np.ones(500)])
    want = np.linalg.lstsq(design, pdf["y"], rcond=None)[0]
    for model in models:
        got = [model[n]["coefficient"] for n in [*names[:3], INTERCEPT]]
        assert np.allclose(got, want, rtol=1e-9) and model["same"]["coefficient"] == 0.0
    table = fit_normal(df, names, "y")
    ours = regression_metrics(predict(df, table), "y", "prediction").first()
    theirs = regression_metrics(fit_place_model(df, names[:3], "y").transform(df), "y", "prediction").first()
    assert ours["r2"] == pytest.approx(theirs["r2"], rel=1e-9)


def test_regression_of_dependent_features_and_few_rows(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0 * i + 1) for i in range(20)] + [(None, 1.0, 1.0)], "a double, b double, y double")
    predicted = predict(df, fit_normal(df, ["a", "b"], "y")).collect()
    assert all(abs(r["prediction"] - r["y"]) < 1e-9 for r in predicted[:20]) and predicted[20]["prediction"] is None
    with pytest.raises(ValueError, match="two complete rows"):
        fit_normal(df.limit(1), ["a"], "y")
