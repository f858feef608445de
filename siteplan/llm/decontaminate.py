"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, stored, whole_text, words
from .shingles import WIDTH, positions_of, shingle_hashes

BITS, BLOCKS, ERRORS = 64, 7, 2
#: With ERRORS errors allowed in a block, BLOCKS * (ERRORS + 1) - 1 errors in all leave a block
#: within them: every fingerprint pair up to this distance meets.
RADIUS = BLOCKS * (ERRORS + 1) - 1
#: First bit and width of each block.
BOUNDS = [(i * BITS // BLOCKS, (i + 1) * BITS // BLOCKS - i * BITS // BLOCKS) for i in range(BLOCKS)]


def fingerprint(hashes: Column) -> Column:
    """64-bit SimHash: per bit the majority over the shingles, each counted as often as it occurs."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda acc, h: acc + F.getbit(h, b).cast("int"))
        return F.when(ones * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(
            F.lit(0).cast("long")
        )

    return F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit), F.lit(0).cast("long"), lambda acc, v: acc.bitwiseOR(v)
    )


def blocks_of(print_: Column) -> Column:
    """The blocks of a fingerprint as (block, value)."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(print_, low).bitwiseAND(F.lit(2**width - 1).cast("long")).alias("value"),
            )
            for i, (low, width) in enumerate(BOUNDS)
        ]
    )


def _masks(width: int) -> list[int]:
    return [sum(1 << b for b in bits) for k in range(ERRORS + 1) for bits in combinations(range(width), k)]


def with_errors(block: Column, value: Column) -> Column:
    """Every value of the block that differs in at most ERRORS bits."""
    by_width = {w: F.array(*[F.lit(m).cast("long") for m in _masks(w)]) for _, w in BOUNDS}
    masks = F.element_at(F.array(*[by_width[w] for _, w in BOUNDS]), (block + 1).cast("int"))
    return F.transform(masks, lambda m: value.bitwiseXOR(m))


def overlap(a: Column, b: Column) -> Column:
    """Common shingles of two lists, each as often as both hold it."""
    counts = lambda s: F.transform(
        F.array_distinct(s), lambda h: F.struct(h.alias("h"), F.size(F.filter(s, lambda x: x == h)).alias("n"))
    )
    repeated = F.aggregate(
        counts(a),
        F.lit(0),
        lambda acc, e: acc + F.least(e["n"], F.size(F.filter(b, lambda x: x == e["h"]))),
    )
    distinct = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(distinct, F.size(F.array_intersect(a, b))).otherwise(repeated)


def least_common(n: Column, percent: int) -> Column:
    """Common shingles that an item of `n` must share for the similarity asked.

    overlap / (n + m - overlap) >= t with a window of m <= n shingles asks for at least t * n.
    """
    return F.ceil(n * F.lit(percent) / F.lit(100)).cast("int")


def _windows(positions: Column, n: Column, need: Column) -> Column:
    """Starts of all windows of `n` shingles that hold at least `need` of the sorted positions."""
    return bind(
        positions,
        lambda p: F.array_distinct(
            F.flatten(
                F.transform(
                    F.filter(
                        F.transform(p, lambda x, i: F.struct(x.alias("x"), F.get(p, i + need - 1).alias("y"))),
                        lambda e: e["y"] - e["x"] < n,
                    ),
                    lambda e: F.sequence(e["y"] - n + 1, e["x"]),
                )
            )
        ),
    )


def leaks(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start): items found in documents.

    Words are runs without ASCII white space, lower-cased; shingles take five words and weigh
    as often as they occur. An item is found where a window as long as the item has a weighted
    Jaccard similarity of percent / 100 or more to it; windows may hang over the ends of a
    text. The best window per document and item is given (ties: the first).

    Nulls, empty texts and items of fewer than five words match nothing; rows of `items` with
    the same item_id are searched each; repeated documents give one row per distinct text.
    Empty tables give an empty result; other columns are not read.

    1. A window reaches the similarity only if enough of its positions hold shingles of items
       of its length: the count per length picks the windows and loses none.
    2. Windows and items get 64-bit SimHash fingerprints; blocks with up to two errors each
       let every pair within RADIUS meet, and the full distance is checked. A pair at the
       least similarity lies beyond with a probability under 5e-4 (`test_fingerprint_radius`);
       windows of four shingles that hang over a text's end against items of five, where
       bits are tied most often, reach 6e-3.
    3. The similarity of the pairs left is computed on the full shingles.
    """
    words_of = words(F.lower(whole_text()))
    wanted = stored(
        items.select("item_id", shingle_hashes(words_of).alias("item_hs")).filter(F.size("item_hs") > 0).select(
            "item_id", "item_hs", F.size("item_hs").alias("n"), fingerprint(F.col("item_hs")).alias("item_print")
        ),
        "items",
    )
    shingles = stored(wanted.select("n", F.explode("item_hs").alias("h")).distinct(), "item-shingles")
    texts = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), "text")
    hits = positions_of(texts, words_of, shingles, shingles.count())
    need = least_common(F.col("n"), percent)
    starts = hits.groupBy("doc_id", "text_hash", "n").agg(F.array_sort(F.collect_set("pos")).alias("positions"))
    starts = starts.select("doc_id", "text_hash", "n", _windows(F.col("positions"), F.col("n"), need).alias("starts"))
    starts = stored(starts.filter(F.size("starts") > 0), "window-starts")

    per_doc = starts.groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash")).agg(
        F.collect_set(F.struct("n", "starts")).alias("found")
    )
    held = texts.join(per_doc, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")))
    held = held.select("doc_id", "text_hash", "found", shingle_hashes(words_of).alias("hs"))
    held = held.select("doc_id", "text_hash", "hs", F.explode("found").alias("f")).select(
        "doc_id", "text_hash", "hs", F.col("f.n").alias("n"), F.explode("f.starts").alias("start")
    )
    first = F.greatest(F.col("start"), F.lit(0))
    window = F.slice(F.col("hs"), first + 1, F.greatest(F.lit(0), F.col("start") + F.col("n") - first))
    windows = held.select("doc_id", "text_hash", "n", "start", window.alias("window")).distinct()
    windows = stored(windows.select("*", fingerprint(F.col("window")).alias("print")), "windows")

    blocks = wanted.select("item_id", "item_hs", "item_print", "n", F.explode(blocks_of(F.col("item_print"))).alias("at"))
    blocks = blocks.select(
        "item_id", "item_hs", "item_print", "n", "at.block", F.explode(with_errors(F.col("at.block"), F.col("at.value"))).alias("value")
    )
    near = windows.select("*", F.explode(blocks_of(F.col("print"))).alias("at")).select("*", "at.block", "at.value").drop("at")
    near = near.join(blocks, ["n", "block", "value"])
    near = near.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
    # of the blocks in which two fingerprints meet only the first gives the pair
    met = F.aggregate(
        F.sequence(F.lit(0), F.lit(BLOCKS - 1)),
        F.lit(BLOCKS),
        lambda acc, b: F.least(
            acc,
            F.when(
                F.bit_count(
                    F.get(blocks_of(F.col("print").bitwiseXOR(F.col("item_print"))), b)["value"]
                ) <= ERRORS,
                b,
            ).otherwise(BLOCKS),
        ),
    )
    near = near.filter(F.col("block") == met)
    common = near.select(
        "doc_id", "text_hash", "item_id", "start",
        overlap(F.col("window"), F.col("item_hs")).alias("common"),
        (F.size("window") + F.size("item_hs")).alias("sizes"),
    )
    found = common.filter(F.col("common") * 100 >= (F.col("sizes") - F.col("common")) * percent)
    found = found.select("doc_id", "text_hash", "item_id", "start", (F.col("common") / (F.col("sizes") - F.col("common"))).alias("similarity"))
    best = F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("before"))).alias("best")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", F.col("best.similarity").alias("similarity"),
        F.greatest(F.lit(0), -F.col("best.before")).cast("long").alias("start"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of `docs` in which no item is found; columns as they are. Cases as in `leaks`."""
    found = stored(leaks(docs, items, percent).select("doc_id", "text_hash").distinct().toDF("leak_id", "leak_hash"), "leaks")
    text_hash = F.xxhash64(whole_text(docs["text"]))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["leak_id"]) & (text_hash == found["leak_hash"]), "left_anti")


def oracle(docs: str = "documents", items: str = "benchmark", percent: int = 80) -> str:
    """(doc_id, item_id, similarity, start) in SQL: every window of every item's length."""
    tokens = (
        "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    )
    parts = " || ' ' || ".join(f"w[p + {k}]" for k in range(1, WIDTH + 1))
    return f"""
    WITH doc_s AS (
      SELECT doc_id, p, {parts} AS s, len(w) - {WIDTH - 1} AS total FROM (
        SELECT doc_id, w, unnest(range(0, len(w) - {WIDTH - 1})) AS p FROM (SELECT doc_id, {tokens} AS w FROM {docs}) a) b),
    item_s AS (
      SELECT item_id, {parts} AS s, len(w) - {WIDTH - 1} AS n FROM (
        SELECT item_id, w, unnest(range(0, len(w) - {WIDTH - 1})) AS p FROM (SELECT item_id, {tokens} AS w FROM {items}) a) b),
    item_c AS (SELECT item_id, s, n, count(*) AS c FROM item_s GROUP BY ALL),
    hits AS (SELECT doc_id, item_id, n, p, total, d.s, c FROM doc_s d JOIN item_c i ON d.s = i.s),
    starts AS (
      SELECT DISTINCT doc_id, item_id, n, total, p - k AS start
      FROM (SELECT doc_id, item_id, n, total, p, unnest(range(0, n)) AS k FROM hits) a),
    counted AS (
      SELECT doc_id, item_id, start, n, total, sum(least(c, times)) AS common FROM (
        SELECT t.doc_id, t.item_id, t.start, t.n, t.total, h.s, any_value(h.c) AS c, count(*) AS times
        FROM starts t JOIN hits h ON h.doc_id = t.doc_id AND h.item_id = t.item_id
         AND h.p >= t.start AND h.p < t.start + t.n GROUP BY ALL) b GROUP BY ALL),
    scored AS (
      SELECT doc_id, item_id, start, common,
             n + least(start + n, total) - greatest(start, 0) - common AS joined FROM counted)
    SELECT doc_id, item_id, max(common / joined) AS similarity,
           CAST(greatest(0, arg_min(start, row(-(common / joined), start))) AS BIGINT) AS start
    FROM scored WHERE 100 * common >= {percent} * joined GROUP BY doc_id, item_id"""
