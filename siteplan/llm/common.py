"""Helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteplan.session import scratch_dir

#: Fixed values of the word and white-space rules.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written once below the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation. Runs at once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters that are not ASCII white space."""
    return F.array_remove(F.split(text, SPACE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def wide_hash(*values: Column | str) -> Column:
    """128 bits as a struct of two longs, safe where 64 bits would collide at 10^12 rows."""
    return F.struct(
        F.xxhash64(*values).alias("a"), F.xxhash64(F.lit(1), *values).alias("b")
    )
