"""Positions of word shingles, and the documents' positions that hold given shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

WIDTH = 5
#: A list of shingles up to this many rows (16 MB of longs) is broadcast; a longer one is
#: joined by shuffle.
BROADCAST_SHINGLES = 1_000_000


def shingle_at(ws: Column, position: Column, width: int = WIDTH) -> Column:
    return F.xxhash64(*[F.get(ws, position + k) for k in range(width)])


def shingle_hashes(ws: Column, width: int = WIDTH) -> Column:
    """The hash of the shingle at each position; empty if there are fewer words than one takes."""
    return F.when(
        F.size(ws) >= width,
        bind(ws, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: shingle_at(w, i, width))),
    ).otherwise(F.array().cast("array<bigint>"))


def positions_of(docs: DataFrame, ws: Column, wanted: DataFrame, wanted_rows: int) -> DataFrame:
    """(doc_id, text_hash, pos, …) for every position of `docs` whose shingle is in `wanted` (h, …).

    `ws` gives the words. Positions are exploded and probed in one pass over the documents
    while `wanted` is small; nothing but the matches leaves a task.
    """
    base = docs.select("doc_id", "text_hash", ws.alias("ws")).filter(F.size("ws") >= WIDTH)
    each = base.select(
        "doc_id", "text_hash", "ws", F.explode(F.sequence(F.lit(0), F.size("ws") - WIDTH)).alias("pos")
    ).select("doc_id", "text_hash", "pos", shingle_at(F.col("ws"), F.col("pos")).alias("h"))
    return each.join(F.broadcast(wanted) if wanted_rows <= BROADCAST_SHINGLES else wanted, "h")
