"""Ranked lexical search over a length-stratified index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, UPPER, stored

#: Fixed values of the terms and the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WEIGHT, TF, SPREAD, FLAT = 1000, 10**9, 12, 25
#: Items and (item, term) entries that are searched together, at most about.
BLOCK_ITEMS = 1024
BLOCK_ENTRIES = 250_000
#: Documents of one stratum that are scored at once, and postings a task holds to order its visits.
CHUNK_DOCS = 4096
HELD_POSTINGS = 2_000_000
#: One document in so many gives the first thresholds.
SEED_SHARE = 64

_FIND = re.compile(TERM).findall
_FOLD = {ord(a): b for a, b in zip(UPPER, LOWER)}


def terms(text: str | None) -> list[str]:
    """The maximal runs of ASCII digits and letters and of all characters beyond ASCII, A-Z lower-cased."""
    return _FIND((text or "").translate(_FOLD))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, qtf): an entry per item row and distinct term. `item` tells rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.string()), ("qtf", pa.int64())])
        for batch in batches:
            for item, item_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = Counter(terms(text))
                columns = [[item] * len(found), [item_id] * len(found), list(found), list(found.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    slim = items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), F.col("text").cast("string")
    )
    return slim.mapInArrow(run, "item long, item_id long, term string, qtf long")


def document_terms(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term; of the postings those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ns, numbers, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(text.as_py())
                if not found:
                    continue
                counts = Counter(found)
                own = [(vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys()]
                ids.append(doc_id)
                ns.append(len(found))
                numbers.append([x for x, _ in own])
                tfs.append([x for _, x in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Stratum:
    """Postings of up to CHUNK_DOCS documents of one normaliser m, by term and tf."""

    def __init__(self, m: int, doc_ids: list, numbers: list, tfs: list, weights: np.ndarray):
        order = [i if i is not None else np.iinfo(np.int64).max for i in doc_ids]
        self.doc_ids, self.no_id = np.array(order, np.int64), np.array([i is None for i in doc_ids])
        lengths = np.array([len(x) for x in numbers])
        docs = np.repeat(np.arange(len(numbers)), lengths)
        term = np.concatenate([np.asarray(x, np.int64) for x in numbers]) if len(docs) else np.empty(0, np.int64)
        tf = np.concatenate([np.asarray(x, np.int64) for x in tfs]) if len(docs) else np.empty(0, np.int64)
        by = np.lexsort((tf, term))
        self.docs, term, tf = docs[by], term[by], tf[by]
        each, where = np.unique(tf, return_inverse=True)
        impact = (TF * each) // (WEIGHT * each + SPREAD * m)  # once per tf of the stratum
        self.gains = weights[term] * impact[where]
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))
        self.best = np.zeros(len(weights), np.int64)  # of a term: its gain at the largest tf
        held = np.flatnonzero(np.diff(self.starts))
        self.best[held] = self.gains[self.starts[held + 1] - 1]

    def scores(self, numbers: np.ndarray, qtfs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.doc_ids), np.int64)
        for t, q in zip(numbers, qtfs):
            a, b = self.starts[t], self.starts[t + 1]
            if a < b:  # a document stands once in a term's postings
                out[self.docs[a:b]] += q * self.gains[a:b]
        return out


class Queries:
    """The items of a block: their terms, and the best documents each has met so far."""

    def __init__(self, starts: np.ndarray, numbers: np.ndarray, qtfs: np.ndarray, least: np.ndarray, k: int):
        self.starts, self.numbers, self.qtfs, self.k = starts, numbers, qtfs, k
        self.least = least.copy()  # a score below cannot be among the k best
        none = np.empty(0, np.int64)
        self.top = [(none, none, np.empty(0, bool)) for _ in least]

    def visit(self, strata: list[Stratum]) -> None:
        """Every item looks at the strata from the highest bound down, and stops below its k-th score."""
        if not len(self.numbers):
            return
        bounds = np.array([np.add.reduceat(self.qtfs * s.best[self.numbers], self.starts[:-1]) for s in strata])
        for i in range(len(self.least)):
            own = slice(self.starts[i], self.starts[i + 1])
            for j in np.argsort(-bounds[:, i], kind="stable"):
                if bounds[j, i] < max(self.least[i], 1):
                    break
                self._take(i, strata[j], strata[j].scores(self.numbers[own], self.qtfs[own]))

    def _take(self, i: int, stratum: Stratum, scores: np.ndarray) -> None:
        good = np.flatnonzero(scores >= max(self.least[i], 1))
        if not len(good):
            return
        old = self.top[i]
        score, doc, no_id = (np.concatenate(x) for x in zip(old, (scores[good], stratum.doc_ids[good], stratum.no_id[good])))
        best = np.lexsort((no_id, doc, -score))[: self.k]
        self.top[i] = (score[best], doc[best], no_id[best])
        if len(best) == self.k:
            self.least[i] = max(self.least[i], self.top[i][0][-1])


def best_per_range(index: DataFrame, weights: np.ndarray, block: tuple, least: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of every item in each range of the index, those under `least` left out.

    `index` is sorted by m within its partitions. A task reads strata into chunks, holds as
    many as HELD_POSTINGS allow, and visits them in the order of their bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(*block, least, k)
        strata, held, m, ids, numbers, tfs = [], 0, None, [], [], []

        def close():
            nonlocal ids, numbers, tfs
            if ids:
                strata.append(Stratum(m, ids, numbers, tfs, weights))
            ids, numbers, tfs = [], [], []

        for batch in batches:
            ms, docs = batch.column("m").to_pylist(), batch.column("doc_id").to_pylist()
            term_rows, tf_rows = batch.column("terms"), batch.column("tfs")
            own_terms, own_tfs = term_rows.values.to_numpy(), tf_rows.values.to_numpy()
            at = term_rows.offsets.to_numpy()
            for r, own_m in enumerate(ms):
                if own_m != m or len(ids) >= CHUNK_DOCS:
                    close()
                    m = own_m
                    if held >= HELD_POSTINGS:
                        queries.visit(strata)
                        strata, held = [], 0
                ids.append(docs[r])
                numbers.append(own_terms[at[r] : at[r + 1]])
                tfs.append(own_tfs[at[r] : at[r + 1]])
                held += at[r + 1] - at[r]
        close()
        if strata:
            queries.visit(strata)
        for i, (score, doc, no_id) in enumerate(queries.top):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), i)), pa.array(doc, mask=no_id), pa.array(score)],
                    names=["item", "doc_id", "score"],
                )

    return index.select("m", "doc_id", "terms", "tfs").mapInArrow(run, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents that score highest for each item.

    Terms, weights and scores as the fixed values say; documents without a term count for
    nothing, items without one get no row. Equal scores go by doc_id, null last. Every row
    of either table counts by itself: copies of a document rank side by side, an item_id that
    repeats gets k rows for each of its rows. Null texts have no term; an empty table gives
    no row; other columns are not read.

    Items are searched in blocks, by hash, of about BLOCK_ITEMS items or BLOCK_ENTRIES terms,
    whose terms the driver holds and sends to the tasks. Per block: one pass over the texts
    stores the postings of the block's terms; the index is range-sorted by (m, hash), so
    strata lie together and a large one spans tasks. Scoring one document in SEED_SHARE gives
    each item a score its k-th best document reaches at least; with that, every range visits
    its strata from the highest bound down and leaves those out that cannot reach it.
    """
    spark = docs.sparkSession
    entries = stored(item_terms(items), "item-terms")
    sized = entries.agg(F.count_distinct("item").alias("items"), F.count(F.lit(1)).alias("entries")).first()
    blocks = max(1, math.ceil(sized["items"] / BLOCK_ITEMS), math.ceil(sized["entries"] / BLOCK_ENTRIES))
    number = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = [_search_block(docs, entries.filter(number == b), k) for b in range(blocks)] if sized["items"] else []
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def _search_block(docs: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = entries.orderBy("item", "term").collect()  # a block, see BLOCK_ENTRIES
    vocabulary = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    items = sorted({r["item"] for r in rows})
    place = {item: i for i, item in enumerate(items)}
    starts = np.searchsorted([place[r["item"]] for r in rows], np.arange(len(items) + 1))
    block = (starts, np.array([vocabulary[r["term"]] for r in rows], np.int64), np.array([r["qtf"] for r in rows], np.int64))

    found = stored(document_terms(docs, vocabulary), "postings")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for t, df in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term of the block
        weights[t] = math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))
    share = F.expr(f"({FLAT} * CAST(n AS DECIMAL(38, 0)) * {n_docs}) div {n_terms or 1}")  # wide: n * N may pass 64 bits
    index = found.filter(F.size("terms") > 0).select(
        "doc_id", (share + (100 - FLAT)).alias("m"), "terms", "tfs", F.xxhash64("doc_id", "n", "terms").alias("h"),
        F.monotonically_increasing_id().alias("place"),
    )

    least = np.zeros(len(items), np.int64)
    seeds = index.filter(F.pmod("h", F.lit(SEED_SHARE)) == 0)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    seeded = best_per_range(seeds.sortWithinPartitions("m"), weights, block, least, k)
    for r in seeded.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k).select("item", "score").collect():
        least[r["item"]] = r["score"]  # a number per item of the block

    ranged = index.repartitionByRange("m", "h", "place").sortWithinPartitions("m")
    best = best_per_range(ranged, weights, block, least, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(place[i], x) for i, x in sorted({(r["item"], r["item_id"]) for r in rows})], "item long, item_id long")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def oracle(docs: str = "documents", items: str = "benchmark", k: int = 20) -> str:
    """The same rows in SQL, every document scored for every item."""
    found = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"
    return f"""
    WITH d AS MATERIALIZED (
      SELECT row_no, doc_id, term, count(*) AS tf
      FROM (SELECT row_no, doc_id, unnest({found}) AS term FROM (SELECT *, row_number() OVER () AS row_no FROM {docs}) a) b
      GROUP BY ALL),
    s AS MATERIALIZED (SELECT row_no, CAST(sum(tf) AS BIGINT) AS n FROM d GROUP BY 1),
    c AS MATERIALIZED (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM s),
    w AS MATERIALIZED (
      SELECT term, CAST(floor({WEIGHT} * ln(CAST(2 * c.docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM d, c GROUP BY term, c.docs),
    q AS MATERIALIZED (
      SELECT item, item_id, term, count(*) AS qtf
      FROM (SELECT item, item_id, unnest({found}) AS term
            FROM (SELECT *, row_number() OVER () AS item FROM {items}) a) b GROUP BY ALL),
    g AS (
      SELECT q.item, q.item_id, d.row_no, d.doc_id,
             CAST(sum(q.qtf * w.w * (({TF} * d.tf) // ({WEIGHT} * d.tf + {SPREAD} * ({100 - FLAT} + ({FLAT} * s.n * c.docs) // c.terms)))) AS BIGINT) AS score
      FROM q JOIN d ON q.term = d.term JOIN w ON w.term = d.term JOIN s ON s.row_no = d.row_no, c GROUP BY 1, 2, 3, 4)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM g WHERE score > 0) r
    WHERE rank <= {k}"""
