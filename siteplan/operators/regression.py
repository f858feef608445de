"""Linear regression on place features, and error measures."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.schemas import PLACE_FEATURES


def fit_place_model(
    df: DataFrame, features: list[str] | None = None, label: str = "cell_tower_num"
) -> PipelineModel:
    """Assemble, standardise (mean and deviation) and fit an unregularised linear regression."""
    stages = [
        VectorAssembler(inputCols=features or PLACE_FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="scaled_features", withMean=True, withStd=True),
        LinearRegression(featuresCol="scaled_features", labelCol=label),
    ]
    return Pipeline(stages=stages).fit(df)


INTERCEPT = "(intercept)"
MODEL = "position int, feature string, mean double, deviation double, coefficient double"


def fit_normal(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Unregularised linear regression on standardised features as a table (MODEL), the intercept at position 0.

    Means, deviations and all co-moments come from one pass of mergeable sums over the rows
    that have every value; the normal equations are solved on a matrix as small as the
    features. A constant feature has coefficient 0; of features that depend on each other
    the shortest solution is taken.
    """
    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"))
    names = [f"x{i}" for i in range(len(features))]
    pairs = [(a, b) for i, a in enumerate(names) for b in [*names[i:], "y"]]
    moments = [F.avg(c).alias(f"m_{c}") for c in [*names, "y"]] + [F.covar_samp(a, b).alias(f"c_{a}_{b}") for a, b in pairs]
    found = rows.na.drop().agg(F.count("*").alias("n"), *moments).first()
    if found["n"] < 2:
        raise ValueError("regression needs two complete rows")
    spread = np.sqrt([max(found[f"c_{a}_{a}"], 0.0) for a in names])
    scale = np.where(spread > 0, spread, 1.0)
    size = len(names)
    gram = np.array([[found[f"c_{names[min(i, j)]}_{names[max(i, j)]}"] for j in range(size)] for i in range(size)]).reshape(size, size)
    moment = np.array([found[f"c_{a}_y"] for a in names])
    solved = np.linalg.lstsq(gram / np.outer(scale, scale), moment / scale, rcond=1e-12)[0] if size else np.zeros(0)
    table = [(0, INTERCEPT, None, None, float(found["m_y"]))]
    table += [
        (i + 1, c, float(found[f"m_x{i}"]), float(spread[i]), float(solved[i]) if spread[i] > 0 else 0.0) for i, c in enumerate(features)
    ]
    return df.sparkSession.createDataFrame(table, MODEL)


def predict(df: DataFrame, model: DataFrame, name: str = "prediction") -> DataFrame:
    """`df` with the regression's value; NULL where a feature is. The model has one row per feature."""
    value = F.lit(0.0)
    for r in model.orderBy("position").collect():
        if r["feature"] == INTERCEPT:
            value = value + F.lit(r["coefficient"])
        elif r["deviation"]:
            value = value + F.lit(r["coefficient"]) * ((F.col(r["feature"]) - F.lit(r["mean"])) / F.lit(r["deviation"]))
    return df.withColumn(name, value)


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row (n, mse, rmse, r2) in one pass."""
    error = F.col(y) - F.col(yhat)
    sums = df.agg(
        F.count("*").alias("n"), F.avg(error * error).alias("mse"), F.var_pop(F.col(y)).alias("spread")
    )
    return sums.select(
        "n", "mse", F.sqrt("mse").alias("rmse"), (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2")
    )
