"""Sampling, splitting and file layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteplan.operators.grid import cell_index
from siteplan.session import scratch_dir


def _draw(keys: list[str], seed: int) -> Column:
    """A whole number below 2^52 drawn from the keys: the same in every run, and in other engines."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def sample_rows(df: DataFrame, fraction: float, seed: int = 0, keys: list[str] | None = None) -> DataFrame:
    """Bernoulli sample without replacement, drawn from the md5 of the keys (by default the whole row).

    The same rows come out in every run and under every partitioning; equal rows stay or go together.
    """
    return df.where(_draw(keys or df.columns, seed) < F.lit(round(fraction * 2**52)))


def _bucket(keys: list[str], n: int, seed: int) -> Column:
    return (_draw(keys, seed) % n).cast("int")


def shard(df: DataFrame, n: int = 12, keys: list[str] | None = None, seed: int = 0, out: str = "shard") -> DataFrame:
    """Rows numbered 0 … n−1 by a hash of the keys; the same row always lands in the same shard."""
    return df.withColumn(out, _bucket(keys or df.columns, n, seed))


def split_train_test(df: DataFrame, keys: list[str], test: float = 0.2, seed: int = 31) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the keys, without a shuffle."""
    bucket, edge = _bucket(keys, 1_000_000, seed), round(test * 1_000_000)
    return df.where(bucket >= edge), df.where(bucket < edge)


def relayout(
    df: DataFrame,
    n: int,
    cols: list[str] | None = None,
    cell: float | None = None,
    xy: tuple[str, str] = ("lon", "lat"),
) -> DataFrame:
    """n partitions: round robin, hashed by columns, or ranges of grid cells.

    With `cell`, rows are range-partitioned by cell and then position, so that neighbours
    share files and a crowded cell still spreads over several partitions.
    """
    if cell is not None:
        return df.repartitionByRange(n, cell_index(xy[0], cell), cell_index(xy[1], cell), *xy)
    return df.repartition(n, *cols) if cols else df.repartition(n)


def chunk_rows(df: DataFrame, order: list[str], size: int = 2000, out: str = "chunk") -> DataFrame:
    """Consecutive chunks of `size` rows in the given order, numbered from 0.

    A global row number would put all rows in one task. Rows are range-partitioned instead
    and stored with their partition number; each partition is numbered on its own and
    shifted by the sizes of those before it. Ties go by a hash of the row, so equal keys
    still spread out.
    """
    spark = df.sparkSession
    tie = F.xxhash64(*df.columns)
    path = scratch_dir(spark, "chunks")
    keyed = df.withColumn("_tie", tie)
    # stored once: a second range partitioning could sample other bounds
    ranged = keyed.repartitionByRange(*[F.col(c) for c in [*order, "_tie"]])
    ranged.withColumn("_pid", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("_pid").agg(F.count("*").alias("_n"))
    # one row per partition, so this window runs over a table as short as the partition count
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_pid", F.coalesce(before, F.lit(0)).alias("_start"))
    number = F.row_number().over(Window.partitionBy("_pid").orderBy(*order, "_tie"))
    numbered = stored.withColumn("_rn", number).join(F.broadcast(starts), "_pid")
    position = F.col("_start") + F.col("_rn") - 1
    return numbered.withColumn(out, F.floor(position / F.lit(size)).cast("long")).select(*df.columns, out)
