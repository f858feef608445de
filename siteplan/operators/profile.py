"""Profiles: column statistics, building shares, raster histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_numeric(df: DataFrame, cols: list[str], quartiles: bool = True, scale: int | None = None) -> DataFrame:
    """One row per column: count, mean, stddev, min, max and approximate quartiles. One pass."""
    aggs = []
    for c in cols:
        total = F.sum(F.col(c).cast(f"decimal(18,{scale})")).cast("double") if scale is not None else F.sum(c)
        fields = [
            F.count(c).alias("count"),
            F.try_divide(total, F.count(c)).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ]
        if quartiles:
            fields += [
                F.percentile_approx(F.col(c).cast("double"), q).alias(f"p{round(q * 100)}") for q in (0.25, 0.5, 0.75)
            ]
        aggs.append(F.struct(F.lit(c).alias("column"), *fields).alias(f"s_{c}"))
    return df.agg(*aggs).select(F.inline(F.array(*[f"s_{c}" for c in cols])))


def building_profile(df: DataFrame, large: float = 500_000) -> DataFrame:
    """Row count and the rows a cleaning by area would drop."""
    return df.agg(
        F.count("*").alias("buildings"),
        F.count_if(F.col("area") == 0).alias("zero_area"),
        F.count_if(F.col("area") >= float(large)).alias("large_area"),
    )


def raster_profile(tiles: DataFrame, bins: int = 10, low: float = 0.0, high: float = 1000.0) -> DataFrame:
    """Per raster: size, valid cells and their share, min, max, mean, and a histogram.

    `histogram` has bins + 2 counts: below `low`, the equal bins up to `high`, and the rest.
    Tiles are aggregated in place; only one row of sums per tile and bin is shuffled.
    """
    cells = tiles.select("source", "file_cols", "file_rows", F.explode("band0").alias("v")).where(~F.isnan("v"))
    binned = cells.groupBy("source", F.width_bucket("v", F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(
        F.count("*").alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    counts = F.map_from_entries(F.collect_list(F.struct(F.col("bin").cast("int"), "n")))
    stats = binned.groupBy("source").agg(
        F.sum("n").alias("valid_cells"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
        (F.sum("s") / F.sum("n")).alias("mean"),
        F.transform(
            F.sequence(F.lit(0), F.lit(bins + 1)), lambda b: F.coalesce(F.try_element_at(counts, b), F.lit(0).cast("long"))
        ).alias("histogram"),
    )
    sizes = tiles.groupBy("source").agg(F.max("file_cols").alias("cols"), F.max("file_rows").alias("rows"))
    return sizes.join(stats, "source", "left").select(
        "source",
        "cols",
        "rows",
        F.coalesce("valid_cells", F.lit(0).cast("long")).alias("valid_cells"),
        F.try_divide(F.coalesce("valid_cells", F.lit(0)), F.col("cols") * F.col("rows")).alias("valid_share"),
        "min",
        "max",
        "mean",
        "histogram",
    )
