"""Token counts: the exact histogram of encoded lengths answers totals for every context limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Where the vocabulary lies on every machine, and its published splitting pattern (fixed value).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space (fixed list) from this length on are cut out before the pattern is
#: applied, which would otherwise go one level deeper per character.
LONG_RUN = 1000
_RUNS = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % LONG_RUN)
#: Lengths per range of the suffix sums.
RANGE = 1024


def encoder(vocabulary: str = VOCABULARY, pattern: str = PATTERN):
    """The byte-pair encoder of a rank file."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counter(vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> Callable[[str], int]:
    """The number of tokens of a text of any length and kind.

    A run of white space is one piece up to the character before the next other one, and
    that last character begins the text that follows; so a long run is encoded as one piece
    and the texts around it by themselves, with the same tokens as all at once.
    """
    own, whole = encoder(vocabulary, pattern), encoder(vocabulary, r"[\s\S]+")

    def count(text: str) -> int:
        n, start = 0, 0
        for run in _RUNS.finditer(text):
            a, b = run.span()
            b = b if b == len(text) else b - 1
            n += len(own.encode_ordinary(text[start:a])) + len(whole.encode_ordinary(text[a:b]))
            start = b
        return n + len(own.encode_ordinary(text[start:]))

    return count


def encoded_lengths(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens) of every whole text; null and empty texts have no token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(vocabulary, pattern)
        for batch in batches:
            counts = [count(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def context_table(histogram: DataFrame) -> DataFrame:
    """One row per occurring length, taken as a context limit, with what the suffix sums say.

    n_docs have exactly this length; docs_at_least and tokens_at_least count documents of this
    length or longer and their tokens; total_docs and total_tokens are over all; kept_tokens is
    the total when every text is cut to this limit; share_within is the share of documents that
    fit, so a quantile is the first row that reaches it. Between two rows kept_tokens grows by
    docs_at_least of the upper row per token of limit, so the table answers every limit.

    Sums run within ranges of RANGE lengths in parallel; one row per range gives the offsets.
    An empty histogram gives an empty table.
    """
    parts = histogram.select("*", F.floor(F.col("n_tokens") / RANGE).alias("part"), (F.col("n_tokens") * F.col("n_docs")).alias("tokens"))
    per_part = parts.groupBy("part").agg(F.sum("n_docs").alias("part_docs"), F.sum("tokens").alias("part_tokens"))
    later = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    per_part = per_part.select(
        "part",
        sum_of("part_docs", later).alias("later_docs"),
        sum_of("part_tokens", later).alias("later_tokens"),
        F.sum("part_docs").over(everything).alias("total_docs"),
        F.sum("part_tokens").over(everything).alias("total_tokens"),
    )
    inside = Window.partitionBy("part").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = parts.join(per_part, "part").select(
        "n_tokens",
        "n_docs",
        (F.col("later_docs") + F.sum("n_docs").over(inside)).alias("docs_at_least"),
        (F.col("later_tokens") + F.sum("tokens").over(inside)).alias("tokens_at_least"),
        "total_docs",
        "total_tokens",
    )
    kept = F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")
    within = (F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")
    return summed.select("*", kept.alias("kept_tokens"), within.alias("share_within"))


def quantile(table: DataFrame, share: float | Column) -> DataFrame:
    """(n_tokens): the least occurring length within which at least `share` of the documents fit."""
    return table.filter(F.col("share_within") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """`context_table` of all documents; repeated rows count each, an empty table gives no row.

    Texts are encoded whole, once; the histogram is written to the scratch folder when called.
    """
    return context_table(stored(length_histogram(encoded_lengths(docs, vocabulary, pattern)), "lengths"))
