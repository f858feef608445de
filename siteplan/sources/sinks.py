"""Writing tables and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    files: int | None = None,
    batch: str | None = None,
    compression: str = "snappy",
) -> None:
    """Parquet output; mode "error" refuses to replace a table.

    `files` fixes the file count. With `batch` the rows replace that batch's folder and leave
    the others alone, so running a batch again does not count it twice.
    """
    if files:
        df = df.repartition(files)
    writer = df.write.option("compression", compression)
    if batch is None:
        writer.mode(mode).parquet(path)
    else:
        tagged = df.withColumn("batch", F.lit(batch))
        (
            tagged.write.option("compression", compression)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .mode("overwrite")
            .parquet(path)
        )


def write_per_source(df: DataFrame, path: str, source: str = "source") -> None:
    """One folder per source file."""
    df.write.mode("overwrite").partitionBy(source).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_net(weights: DataFrame, ranges: DataFrame, path: str) -> None:
    """A net's weights and the ranges its inputs were scaled by, in one folder."""
    weights.write.mode("overwrite").parquet(f"{path.rstrip('/')}/weights")
    ranges.write.mode("overwrite").parquet(f"{path.rstrip('/')}/ranges")


def load_net(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    base = path.rstrip("/")
    return spark.read.parquet(f"{base}/weights"), spark.read.parquet(f"{base}/ranges")
