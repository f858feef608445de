"""The training-data queries over the given tables, with plain SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    html_extract,
    lexical_search,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    prefix_trie,
    quality,
    quality_model,
    sharding,
    token_counts,
    url_filter,
)
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("text_hash")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


#: Rules of the URL query (fixed values).
URL_RULES = [
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_html_extract": op4_html_extract,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_source_mix": op8_source_mix,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality_model": op10_quality_model,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_feistel_shards": op12_feistel_shards,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op1_quality_rules": f"""SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        base_failed, kept FROM ({quality.oracle()}) q""",
    "op3_license_scan": license_scan.oracle(),
    "op4_html_extract": html_extract.oracle(),
    "op6_url_filter": url_filter.oracle(URL_RULES),
    "op5_minhash_dedup": near_dedup.oracle(width=2),
    "op7_line_dedup": f"""SELECT doc_id, n_lines, n_dropped, sha256(kept_text) AS kept_sha256
        FROM ({line_dedup.oracle()}) q""",
    "op8_source_mix": f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.oracle()}) q",
    "op9_decontaminate": decontaminate.oracle(),
    "op11_prefix_trie": prefix_trie.oracle(),
    "op12_feistel_shards": sharding.oracle(),
    "op13_ranked_search": lexical_search.oracle(),
}
