"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of the documents table; the last adds the mix's figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siteplan.llm import decontaminate, line_dedup, mixing, near_dedup, quality
from siteplan.llm.common import DOCUMENT_COLUMNS, stored, table, whole_text


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.quality_filter(docs.select(*DOCUMENT_COLUMNS))


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more documents hold; n_chars follows."""
    cut = line_dedup.line_dedup(docs.select(*DOCUMENT_COLUMNS))
    return cut.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.char_length("kept_text").cast("long").alias("n_chars"),
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    return near_dedup.first_of_each(docs.select(*DOCUMENT_COLUMNS))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminate(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes words from, with size, source_size, target and taken."""
    docs = docs.select(*DOCUMENT_COLUMNS, F.xxhash64(whole_text()).alias("text_hash"))
    key = ["doc_id", "source", "text_hash"]
    copy = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))  # repeated rows pair off one by one
    taken = mixing.mix_sources(docs).withColumn("copy", copy).filter("taken > 0")
    taken = taken.select(*[F.col(k).alias(f"mix_{k}") for k in key], "copy", "size", "source_size", "target", "taken")
    docs = docs.withColumn("doc_copy", copy)
    same = [docs[k].eqNullSafe(taken[f"mix_{k}"]) for k in key] + [docs["doc_copy"] == taken["copy"]]
    return docs.join(taken, same).select(*DOCUMENT_COLUMNS, "size", "source_size", "target", "taken")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_frequent_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_to_weights),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


_COLUMNS = ", ".join(DOCUMENT_COLUMNS)

ORACLE_SQL = f"""
WITH s1 AS MATERIALIZED (SELECT {_COLUMNS} FROM ({quality.oracle('documents')}) q WHERE kept),
s2 AS MATERIALIZED (
  SELECT doc_id, kept_text AS text, lang, source, CAST(length(kept_text) AS BIGINT) AS n_chars
  FROM ({line_dedup.oracle('s1')}) q),
s3 AS MATERIALIZED (
  SELECT {_COLUMNS} FROM s2 WHERE doc_id IN (SELECT doc_id FROM ({near_dedup.oracle('s2')}) q WHERE kept)),
s4 AS MATERIALIZED (
  SELECT {_COLUMNS} FROM s3 WHERE doc_id NOT IN (SELECT doc_id FROM ({decontaminate.oracle('s3')}) q))
SELECT {_COLUMNS}, size, source_size, target, taken FROM ({mixing.oracle('s4')}) q WHERE taken > 0"""
