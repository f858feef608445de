"""Feature scaling. Column statistics enter as one-row scalar subqueries: no join, no driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stats(df: DataFrame, fields: list[Column]) -> Column:
    return df.agg(F.struct(*fields).alias("stats")).scalar()


def normalise_by_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """x / max(x), replacing the column."""
    return df.withColumn(out, F.try_divide(F.col(col), df.agg(F.max(col)).scalar())).drop(*([col] if out != col else []))


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x − mean) / sample standard deviation; a constant column becomes 0."""
    fields = [f(F.col(c)).alias(f"{n}_{c}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    stats = _stats(df, fields)
    scaled = {
        c: F.when(
            F.col(c).isNotNull(),
            F.coalesce(F.try_divide(F.col(c) - stats[f"mean_{c}"], stats[f"std_{c}"]), F.lit(0.0)),
        )
        for c in cols
    }
    return df.withColumns(scaled)


def minmax_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """The fitted ranges as a table (column, low, high), to be stored with a model."""
    fields = [F.struct(F.lit(c).alias("column"), F.min(c).alias("low"), F.max(c).alias("high")) for c in cols]
    return df.agg(F.array(*fields).alias("ranges")).select(F.inline("ranges"))


def minmax_scale(df: DataFrame, cols: list[str], ranges: DataFrame | None = None) -> DataFrame:
    """(x − min) / (max − min); without `ranges` they are fitted on df.

    A column that was constant when the range was fitted gives x − min, so 0 for that value.
    A column without a range is an error.
    """
    if ranges is None:
        fitted = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")) for c in cols]
        stats = _stats(df, [f.alias(f"r{i}") for i, f in enumerate(fitted)])
    else:
        stats = _stats(ranges, [_range_of(c).alias(f"r{i}") for i, c in enumerate(cols)])
    scaled = {}
    for i, c in enumerate(cols):
        low, high = stats[f"r{i}"]["low"], stats[f"r{i}"]["high"]
        share = F.when(high == low, F.col(c) - low).otherwise((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)))
        scaled[c] = share.cast("double")
    return df.withColumns(scaled)


def _range_of(c: str) -> Column:
    """The stored range of a column, looked up once for the whole table."""
    own = F.col("column") == c
    return F.when(F.count_if(own) == 0, F.raise_error(F.lit(f"no range for column {c}"))).otherwise(
        F.max(F.when(own, F.struct("low", "high")))
    )
