"""Cleaning, filtering and combining tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The training and the test region, (west, south, east, north).
TRAIN_BOX = (-125.0, 33.0, -71.0, 42.0)
TEST_BOX = (-124.0, 46.0, -117.0, 48.0)
# The country codes kept from the antenna records.
MCC_CODES = ("310", "311", "312", "313", "314", "315", "316")


def filter_codes(cells: DataFrame, radio: str = "LTE", mccs=MCC_CODES) -> DataFrame:
    return cells.where((F.col("radio") == radio) & F.col("mcc").isin([str(m) for m in mccs]))


def build_towers(cells: DataFrame, radio: str = "LTE", mccs=MCC_CODES, divisor: int = 256, keys: tuple[str, ...] = ()) -> DataFrame:
    """Towers as the centroids of the antenna cells that share cell // divisor.

    Equal ids of different operators fall together unless `keys` (such as mcc, net) tells
    them apart.
    """
    tower = F.floor(F.col("cell") / F.lit(divisor)).alias("bsid")
    grouped = filter_codes(cells, radio, mccs).groupBy(*keys, tower)
    return grouped.agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat")).select("bsid", *keys, "lon", "lat")


def bbox_filter(df: DataFrame, x: str, y: str, box: tuple[float, float, float, float], inclusive: bool = True) -> DataFrame:
    west, south, east, north = box
    cx, cy = F.col(x), F.col(y)
    if inclusive:
        return df.where(cx.between(west, east) & cy.between(south, north))
    return df.where((cx > west) & (cx < east) & (cy > south) & (cy < north))


def bbox_split(df: DataFrame, x: str, y: str, train=TRAIN_BOX, test=TEST_BOX) -> tuple[DataFrame, DataFrame]:
    """The rows in the training box and those in the test box."""
    return bbox_filter(df, x, y, train), bbox_filter(df, x, y, test)


def clean_buildings(df: DataFrame, min_excl: float = 0, max_excl: float = 500_000) -> DataFrame:
    """Buildings with an area other than `min_excl` and below `max_excl`."""
    return df.where((F.col("area") != float(min_excl)) & (F.col("area") < float(max_excl)))


def nan_to_null(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.when(~F.isnan(col), F.col(col)))


def drop_all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop("all", subset=list(cols))


def clean_elevation(df: DataFrame, col: str = "elevation") -> DataFrame:
    return drop_all_null(nan_to_null(df, col), [col])


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL (and NaN) to 0 in numeric columns."""
    return df.na.fill(0, cols)


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by position."""
    return reduce(DataFrame.union, dfs)


def union_by_name(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column missing on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def nearest_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in the given order, as one aggregate instead of a sort per key."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in rest])
