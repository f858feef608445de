"""Lattice points: scores, neighbourhood features, the net on them and the choice of sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siteplan.functions.scoring import point_score
from siteplan.operators.aggregates import count, total
from siteplan.operators.attach import attach
from siteplan.operators.clean import dedup_rows, fill_zero
from siteplan.operators.layout import chunk_rows, split_train_test
from siteplan.operators.mlp import mlp_descend, mlp_score
from siteplan.operators.placement import greedy_place
from siteplan.operators.radius import inverse_square_score, nearest_and_count, neighbour_percent_rank, radius_features
from siteplan.operators.regression import regression_metrics
from siteplan.operators.scale import minmax_ranges, minmax_scale
from siteplan.schemas import BUILDING_RADII, FEATURE_RADII, POINT_FEATURES
from siteplan.sources.sinks import write_csv

KEY = ["lon", "lat"]


def point_features(
    points: DataFrame,
    towers: DataFrame,
    population: DataFrame,
    elevation: DataFrame,
    buildings: DataFrame,
    scale: int | None = None,
    radius: float = 0.4,
) -> DataFrame:
    """Points with n, d, score and the 22 neighbourhood features. Each part goes by position alone."""
    base = points.select(*KEY).distinct()
    scored = nearest_and_count(base, towers, radius)
    scored = scored.withColumn("score", point_score("n", "d"))
    built = radius_features(
        base,
        buildings,
        {"building_cnt_{}": count(), "building_area_{}": total("area", scale)},
        BUILDING_RADII,
        other_xy=("center_longitude", "center_latitude"),
        fill_zero=True,
    )
    ranked = neighbour_percent_rank(base, elevation)
    people = radius_features(base, population, {"pop_{}_sum": total("pop_cnt", scale)}, FEATURE_RADII)
    table = scored
    for part in (built, ranked, people):
        table = attach(table, part, KEY)
    return table


def rescore_points(points: DataFrame, towers: DataFrame, radius: float = 0.4) -> DataFrame:
    """Points with the inverse-square score in place of their old one, NULL features as 0."""
    kept = fill_zero(points.drop("score", "n", "d"))
    return attach(inverse_square_score(kept, fill_zero(towers), radius), kept, KEY, "left")


def train_point_model(table: DataFrame, features: list[str] = POINT_FEATURES, label: str = "score", **options):
    """(weights, ranges, predictions, measures) of the net trained by synchronous steps on 80 % of the points."""
    clean = dedup_rows(fill_zero(table.select(*KEY, *features, label)))
    ranges = minmax_ranges(clean, features)
    train, test = split_train_test(minmax_scale(clean, features, ranges), KEY)
    weights = mlp_descend(train, features, label, **options)
    predictions = mlp_score(test, features, weights, name="y_pred").withColumnRenamed(label, "y_test")
    return weights, ranges, predictions.select("y_pred", "y_test"), regression_metrics(predictions, "y_test", "y_pred")


def place_sites(
    table: DataFrame,
    weights: DataFrame,
    features: list[str] = POINT_FEATURES,
    ranges: DataFrame | None = None,
    out: str = "sigmoid",
    n: int = 1000,
    radius: float = 0.4,
) -> DataFrame:
    """The n best sites by the net's score. Without `ranges` the scaling is fitted on this table."""
    clean = dedup_rows(fill_zero(table.select(*KEY, *features)))
    scored = mlp_score(minmax_scale(clean, features, ranges), features, weights, out)
    return greedy_place(scored.select(*KEY, "score"), n, radius)


def write_sites(spark: SparkSession, sites: DataFrame, path: str, size: int = 2000) -> None:
    """Picks as CSV, one folder per chunk of `size` picks in pick order."""
    chunks = chunk_rows(sites, ["pick"], size)
    chunks.select(*KEY, "score", "chunk").write.mode("overwrite").option("header", True).partitionBy("chunk").csv(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    write_csv(predictions, path)
