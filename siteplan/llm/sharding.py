"""Sharding by a Feistel permutation of global row numbers: a reproducible shuffle into even shards."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole_text
from .crc import TABLE, crc32_sql
from .ranges import in_order, part_starts

ROUNDS = 8
#: The field of the round function; half-blocks stay below 31 bits, row counts below 2^62.
PRIME = 2**31 - 1
FACTOR = 48271


def round_keys(seed: str) -> list[int]:
    return [zlib.crc32(f"{seed}:{r}".encode()) % PRIME for r in range(ROUNDS)]


def half_bits(rows: int) -> int:
    """Bits of a half-block: the smallest b with 4^b >= rows."""
    return max(1, -(-max(rows - 1, 1).bit_length() // 2))


def _mix(half, key: int):
    """The round function on whole numbers below 2^31; no product passes 2^62."""
    x = (half * FACTOR + key) % PRIME
    return (x * x + x + key) % PRIME


def _walk(numbers: np.ndarray, rows: int, once) -> np.ndarray:
    """`once` applied to each number, again and again where the result is no row number."""
    out = once(numbers)
    while (far := out >= rows).any():
        out[far] = once(out[far])
    return out


def permute(numbers: np.ndarray, rows: int, seed: str) -> np.ndarray:
    """Where each row number goes in the shuffled order; a bijection of 0 .. rows - 1."""
    bits, keys = half_bits(rows), round_keys(seed)
    mask = (1 << bits) - 1

    def once(n):
        left, right = n >> bits, n & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        return (left << bits) | right

    return _walk(np.asarray(numbers, dtype=np.int64), rows, once)


def unpermute(places: np.ndarray, rows: int, seed: str) -> np.ndarray:
    """The row number at each place of the shuffled order."""
    bits, keys = half_bits(rows), round_keys(seed)
    mask = (1 << bits) - 1

    def once(n):
        left, right = n >> bits, n & mask
        for key in reversed(keys):
            left, right = right ^ (_mix(left, key) & mask), left
        return (left << bits) | right

    return _walk(np.asarray(places, dtype=np.int64), rows, once)


def permuted(number: Column, rows: int, seed: str) -> Column:
    @F.pandas_udf("long")
    def run(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), rows, seed))

    return run(number)


def assign_shards(docs: DataFrame, shards: int = 24, seed: str = "shards", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of `docs`, and columns to carry.

    Rows are numbered in the order of doc_id (null first), CRC-32, size and MD5 of the text;
    the number goes through a keyed Feistel network over the next power of four, walking on
    while the result is no row number. Place p lies in shard p mod shards at slot p div
    shards, so counts differ by one at most (`law` is rows), slots have no gap, and both
    follow from the number alone, as does the number from them (`unpermute`). Rows of a
    larger shard count are not held, so grown_shard is null.

    Size is the text's UTF-8 bytes plus 8; a null text counts as empty. Repeated rows are
    rows of their own, told apart by their place in the scan; an empty table gives an empty
    table. Other columns are not read unless carried (texts then go through the exchange);
    carried names that clash with the result's are an error of the caller.

    Only digests are shuffled, once, by sampled ranges, so no doc_id and no group of copies
    meets in a task; the driver gets the row count. Writes digests and order to the scratch
    folder when called.
    """
    text = F.encode(whole_text(F.col("text").cast("string")), "UTF-8")
    digests = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("text_md5"),
            F.monotonically_increasing_id().alias("place"),
            *carry,
        ),
        "digests",
    )
    ordered = in_order(digests, ["doc_id", "text_crc32", "size", "text_md5", "place"], "row-order")
    starts = part_starts(ordered)
    rows = ordered.count()
    numbered = ordered.join(F.broadcast(starts), "part").withColumn("number", F.col("before") + F.col("at") - F.col("first_at"))
    placed = numbered.withColumn("to", permuted(F.col("number"), rows, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("to") % shards).cast("int").alias("shard"),
        F.expr(f"`to` div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *carry,
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: str = "shards") -> None:
    """All columns of `docs` below `path`, a folder per shard, rows in the order of their slots.

    A shard is cut into ranges of slots, so a file never holds a whole large shard. Columns
    named like those of `assign_shards` other than doc_id are not written.
    """
    own = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "text_md5", "place", "part", "at"]
    placed = assign_shards(docs, shards, seed, tuple(c for c in docs.columns if c not in own))
    ranged = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.drop("size", "text_crc32", "law", "grown_shard").write.partitionBy("shard").parquet(path)


def oracle(docs: str = "documents", shards: int = 24, seed: str = "shards") -> str:
    """The same rows in SQL; the network's rounds are unrolled, the cycle walk is a recursion."""
    def rounds(source: str) -> str:
        out = f"(SELECT number, bits, rows, n >> bits AS a, n & ((CAST(1 AS BIGINT) << bits) - 1) AS b FROM {source})"
        for i, key in enumerate(round_keys(seed)):
            x = f"((b * {FACTOR} + {key}) % {PRIME})"
            out = (
                f"(SELECT number, bits, rows, b AS a, xor(a, (({x} * {x} + {x} + {key}) % {PRIME}) "
                f"& ((CAST(1 AS BIGINT) << bits) - 1)) AS b FROM {out} r{i})"
            )
        return f"SELECT number, bits, rows, (a << bits) | b AS n FROM {out} z"

    return f"""
    WITH RECURSIVE digests AS MATERIALIZED (
      SELECT doc_id, CAST(octet_length(encode(t)) + 8 AS BIGINT) AS size, {crc32_sql('t')} AS text_crc32, md5(t) AS digest
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM {docs}) d, {TABLE} c),
    numbered AS MATERIALIZED (
      SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size, digest) - 1 AS number,
             count(*) OVER () AS rows FROM digests),
    sized AS MATERIALIZED (
      SELECT number, rows, number AS n,
             greatest(1, CAST(ceil(length(ltrim(bin(greatest(rows - 1, 1)), '0')) / 2) AS BIGINT)) AS bits FROM numbered),
    walk AS (
      {rounds('sized')}
      UNION ALL
      {rounds('(SELECT * FROM walk WHERE n >= rows)')})
    SELECT d.doc_id, d.size, d.text_crc32, 'rows' AS law, CAST(w.n % {shards} AS INT) AS shard,
           CAST(w.n // {shards} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
    FROM numbered d JOIN walk w ON d.number = w.number WHERE w.n < w.rows"""
