"""Rectangles: features of random places and the regression on them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteplan.functions.geo import rect_area
from siteplan.operators.aggregates import count, deviation, mean, total
from siteplan.operators.attach import attach
from siteplan.operators.clean import fill_zero
from siteplan.operators.layout import split_train_test
from siteplan.operators.range_join import BOUNDS, range_join
from siteplan.operators.regression import fit_normal, fit_place_model, predict, regression_metrics
from siteplan.operators.scale import normalise_by_max
from siteplan.schemas import PLACE_FEATURES


def place_features(
    places: DataFrame,
    towers: DataFrame,
    population: DataFrame,
    elevation: DataFrame,
    buildings: DataFrame,
    scale: int | None = None,
) -> DataFrame:
    """Places with area, tower count, normalised population, elevation and building totals.

    Places without any elevation pixel drop out, as in the inner join this step is. `scale`
    makes the sums exact decimals with that many digits.
    """
    base = places.select(*BOUNDS).distinct()
    towers_in = range_join(base, towers, ("lon", "lat"), {"cell_tower_num": count("bsid", "lon", "lat")})
    people = range_join(base, population, ("lon", "lat"), {"pop_cnt_sum": total("pop_cnt", scale)})
    relief = {"avg_elevation": mean("elevation", scale), "stddv_elevation": deviation("elevation", scale)}
    ground = range_join(base, elevation, ("longitude", "latitude"), relief, strict=False, how="inner")
    built = {"total_building_cnt": count("area"), "total_building_area": total("area", scale)}
    houses = range_join(base, buildings, ("center_longitude", "center_latitude"), built)
    # each part joins the bare rectangles: chained, every step would redo all steps before it
    table = places.withColumn("area", rect_area(*BOUNDS))
    for part in (towers_in, normalise_by_max(people, "pop_cnt_sum", "pop_cnt_sum_norm"), fill_zero(ground, list(relief)), houses):
        table = attach(table, part, list(BOUNDS))
    return table


def train_place_model(
    features: DataFrame, label: str = "cell_tower_num", test: float = 0.2
) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline and its measures on the rows held back."""
    train, held = _train_and_held(features, label, test)
    model = fit_place_model(train, PLACE_FEATURES, label)
    return model, regression_metrics(model.transform(held), label, "prediction")


def train_place_regression(
    features: DataFrame, label: str = "cell_tower_num", test: float = 0.2
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same regression from one pass of sums: its table of coefficients, the held rows with `prediction`, and the measures."""
    train, held = _train_and_held(features, label, test)
    model = fit_normal(train, PLACE_FEATURES, label)
    predicted = predict(held, model)
    return model, predicted, regression_metrics(predicted, label, "prediction")


def _train_and_held(features: DataFrame, label: str, test: float) -> tuple[DataFrame, DataFrame]:
    filled = fill_zero(features).withColumn(label, F.col(label).cast("double"))
    return split_train_test(filled, list(BOUNDS), test)
