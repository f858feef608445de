"""MinHash near-dedup: signatures joined within a Hamming radius, links confirmed exactly.

A document is its set of distinct word shingles. Its signature holds 65 MinHash values of
16 bits, split into 13 chunks of five. If two signatures differ in at most 25 values, some
chunk differs in at most one (13 chunks with two errors each would need 26), so the two
share a key made of a chunk with one value left out: 65 keys a document find every pair
within the radius. A pair at similarity 0.8 is beyond it with a probability near 1e-4.
Beside the signature stands a sketch, the 192 least hashes of the set: it holds a small set
whole and estimates the similarity of larger ones, which spares most exact comparisons.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .graph import connected_components
from .ranges import split_join

VALUES, CHUNKS = 65, 13
WIDTH = VALUES // CHUNKS
RADIUS = 2 * CHUNKS - 1
#: Rounds that compare a bucket with one member, before what is left is compared in blocks.
STAR_ROUNDS = 2
#: Members of a bucket compared in one task.
BLOCK = 4096
#: A bucket's rows are cut into parts in the joins by key from so many rows on.
HOT_BUCKET = 1000
#: Hashes of a set's sketch, and how many standard deviations below the asked similarity an
#: estimate may lie (a pair lies further below with a probability near 1e-4).
SKETCH, SLACK = 192, 3.7
#: Words remembered by a task.
CACHE = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    """64-bit hash of a word, computed once per task while it fits."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def shingle_set(text: str | None, width: int, known: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of `width` words; A-Z lower-cased.

    With fewer words the whole sequence is one shingle; without words the set is empty.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    width = min(width, len(hashed))
    n = len(hashed) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = (total ^ hashed[k : k + n]) * _MIX
        total ^= total >> np.uint64(29)
    return np.unique(total)


def _multipliers() -> np.ndarray:
    return np.random.default_rng(5).integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The low bits of the least hash under each of the functions."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[None, start : start + 2048] * multipliers[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least * _MIX2) >> np.uint64(48)).astype(np.uint16)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The high halves of the least hashes of a sorted set, filled up with the greatest value."""
    out = np.full(SKETCH, 2**32 - 1, np.uint32)
    least = (shingles[:SKETCH] >> np.uint64(32)).astype(np.uint32)
    out[: len(least)] = least
    return out


def sketches_near(one: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of `others` may be similar enough to `one` by their sketches.

    Up to the lesser of the two sketches' ends both sets are known; what they share there
    estimates the similarity, and gives it where both sets are held whole.
    """
    last = np.uint64(2**32 - 1)
    whole, wholes = n <= SKETCH, sizes <= SKETCH
    ends = np.minimum(last if whole else one[-1], np.where(wholes, last, others[:, -1]))
    mine = np.minimum(np.searchsorted(one, ends, side="right"), min(n, SKETCH))
    theirs = np.minimum((others <= ends[:, None]).sum(axis=1), np.minimum(sizes, SKETCH))
    at = np.minimum(np.searchsorted(one, others), SKETCH - 1)
    inside = np.arange(SKETCH)[None, :] < theirs[:, None]
    common = ((one[at] == others) & inside & (at < mine[:, None])).sum(axis=1)
    union = np.maximum(1, mine + theirs - common)
    share = percent / 100
    slack = np.where(wholes & whole, 2 / union, SLACK * np.sqrt(share * (1 - share) / union) + 2 / union)
    return common / union >= share - slack


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, sig, sketch) per row; the last three null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, multipliers = _WordHashes(), _multipliers()
        for batch in batches:
            sizes, hashes, sigs, sketches = [], [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), width, known)
                sizes.append(len(found))
                hashes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sigs.append(signature(found, multipliers).tobytes() if len(found) else None)
                sketches.append(sketch(found).tobytes() if len(found) else None)
            parts = [pa.array(c, pa.binary()) for c in (hashes, sigs, sketches)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), *parts],
                ["doc_id", "n_shingles", "set_hash", "sig", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, set_hash binary, sig binary, sketch binary"
    )


def chunk_keys(sigs: np.ndarray) -> np.ndarray:
    """(documents, 65) keys: each chunk with each of its values left out."""
    chunks = sigs.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    keys = np.empty((len(chunks), CHUNKS, WIDTH), np.uint64)
    for out in range(WIDTH):
        packed = np.zeros(chunks.shape[:2], np.uint64)
        for k in range(WIDTH):
            if k != out:
                packed = (packed << np.uint64(16)) | chunks[:, :, k]
        keys[:, :, out] = packed * _MIX
    slots = np.arange(VALUES, dtype=np.uint64) * _MIX2
    return keys.reshape(-1, VALUES) + slots[None, :]


def _sig_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def keyed(classes: DataFrame) -> DataFrame:
    """(key, slot, rep, n): 65 rows per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                keys = chunk_keys(_sig_matrix(part.column("sig")))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view(np.int64)),
                        pa.array(np.tile(np.arange(VALUES, dtype=np.int8), part.num_rows)),
                        pa.array(np.repeat(part.column("rep").to_numpy(), VALUES)),
                        pa.array(np.repeat(part.column("n").to_numpy(), VALUES)),
                    ],
                    ["key", "slot", "rep", "n"],
                )

    return classes.select("rep", "n", "sig").mapInArrow(run, "key long, slot byte, rep long, n long")


def _sizes_fit(n: str, m: str, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def within_radius(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most RADIUS values."""
    sig_a = classes.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    sig_b = classes.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = (_sig_matrix(batch.column("sig_a")) != _sig_matrix(batch.column("sig_b"))).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(apart <= RADIUS))

    return pairs.join(sig_b, "b").join(sig_a, "a").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def measured(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, common, linked): the size of the full sets' intersection, and whether
    100 * intersection >= percent * union."""
    text_a = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, set_a = _WordHashes(), None, None
        for batch in batches:
            common, linked = [], []
            for text_a, text_b in zip(batch.column("text_a"), batch.column("text_b")):
                text_a = text_a.as_py()
                if text_a != last:
                    last, set_a = text_a, shingle_set(text_a, width, known)
                set_b = shingle_set(text_b.as_py(), width, known)
                both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                common.append(both)
                linked.append(100 * both >= percent * (len(set_a) + len(set_b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(linked, pa.bool_())],
                ["a", "b", "common", "linked"],
            )

    joined = pairs.join(text_b, "b").join(text_a, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long, common long, linked boolean")


def _can_reach(n, m, c, d, least, percent: int):
    """False if two sets of n and m shingles, c and d of them in one third set, can't be similar enough.

    They share at most the lesser of c and d inside the third set, and outside it at most
    the lesser of their rests. `least` is the minimum of two columns or arrays.
    """
    most = least(c, d) + least(n - c, m - d)
    return most * 100 >= (n + m - most) * percent


def block_pairs(open_rows: DataFrame, percent: int, total: int) -> DataFrame:
    """All pairs (a, b) of different components in a bucket that are within RADIUS, may be
    similar enough by their sizes, their sketches and what they share with the bucket's
    center; each once.

    A bucket is cut into blocks of about BLOCK members, every two blocks meet in one task.
    Of the keys two signatures share only the first gives the pair. `total` bounds the rows.
    """
    sizes = open_rows.groupBy("key").agg(F.count(F.lit(1)).alias("in_key"))
    sizes = sizes.withColumn("n_blocks", F.ceil(F.col("in_key") / BLOCK).cast("int"))
    mine = F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int")
    dealt = split_join(open_rows, sizes, ["key"], "in_key", total, HOT_BUCKET).withColumn("mine", mine)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "key", "slot", "rep", "n", "common", "comp", "sig", "sketch", "mine",
        F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
    )

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        rep, comp = rows.column("rep").to_numpy(), rows.column("comp").to_numpy()
        mine, slot = rows.column("mine").to_numpy(), rows.column("slot")[0].as_py()
        sigs = _sig_matrix(rows.column("sig").combine_chunks())
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint32).reshape(-1, SKETCH)
        n, common = rows.column("n").to_numpy(), rows.column("common").to_numpy()  # NaN: not known
        left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        chunk, out_a, out_b = slot // WIDTH, [], []
        for i in left:
            others = right[(comp[right] != comp[i]) & ((rep[right] > rep[i]) if low == high else True)]
            fit = np.minimum(n[others], n[i]) * 100 >= np.maximum(n[others], n[i]) * percent
            near = _can_reach(n[others], n[i], common[others], common[i], np.minimum, percent)
            others = others[fit & (near | np.isnan(common[others]) | np.isnan(common[i]))]
            if not len(others):
                continue
            differ = sigs[others] != sigs[i]
            near = differ.sum(axis=1) <= RADIUS
            others, differ = others[near], differ[near].reshape(-1, CHUNKS, WIDTH)
            errors = differ.sum(axis=2)
            first = (errors <= 1).argmax(axis=1)
            gone = np.where(errors[np.arange(len(first)), first] == 1, differ[np.arange(len(first)), first].argmax(axis=1), 0)
            own = others[(first == chunk) & (gone == slot % WIDTH)]
            if len(own):
                own = own[sketches_near(sketches[i], n[i], sketches[own], n[own], percent)]
            out_a += [min(rep[i], rep[j]) for j in own]
            out_b += [max(rep[i], rep[j]) for j in own]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return dealt.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Documents are linked when 100 * |A and B| >= percent * |A or B| of their shingle sets;
    component_id is the smallest doc_id reachable, kept marks the row of that id. Null, empty
    and blank texts have empty sets and are linked with nothing. Rows with the same doc_id
    and set are one document; a doc_id with several texts links them. A row without doc_id
    has no component and is kept. An empty table gives an empty table; other columns are not
    read.

    Equal sets form one class; classes meet in buckets of equal keys. A bucket is first
    compared with one member only, for STAR_ROUNDS rounds; pairs across the components that
    remain are then compared in full, in blocks, save those that what they share with the
    bucket's center proves too different. So copies are never expanded into all pairs and no
    link between different components is left out. Works in several stored steps.
    """
    rows = stored(signatures(docs, width), "signatures")
    named = rows.filter(F.col("doc_id").isNotNull() & F.col("set_hash").isNotNull())
    classes = stored(
        named.groupBy("set_hash").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"),
            F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("members"),
        ),
        "classes",
    )
    keys = keyed(classes)
    buckets = stored(
        keys.groupBy("key").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("members")).filter("members > 1"),
        "buckets",
    )
    total = VALUES * classes.count()  # no later table has more rows by key
    counted = buckets.withColumn("in_key", F.col("members")).hint("shuffle_hash")
    live = stored(split_join(keys, counted, ["key"], "in_key", total, HOT_BUCKET), "live")
    center_size = classes.select(F.col("rep").alias("center"), F.col("n").alias("center_n"))
    pairs = live.filter("rep <> center").select("center", "rep", "n").distinct().join(center_size, "center")
    pairs = pairs.filter(_sizes_fit("n", "center_n", percent)).select(F.col("center").alias("a"), F.col("rep").alias("b"))
    near = stored(within_radius(pairs, classes), "pairs")

    wanted = near.select(F.col("a").alias("rep")).union(near.select("b")).union(live.filter("members > 2").select("rep"))
    text = docs.select(F.col("doc_id").cast("long").alias("rep"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = stored(text.join(wanted.distinct(), "rep", "left_semi"), "texts")

    tested = stored(measured(near, texts, width, percent), "tested")
    several = named.groupBy("doc_id").agg(F.min("set_hash").alias("x"), F.max("set_hash").alias("y")).filter("x <> y")
    same_id = (
        named.join(several.select("doc_id"), "doc_id")
        .join(classes.select("set_hash", "rep"), "set_hash")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    edges = tested.filter("linked").select("a", "b").union(stored(same_id, "edges"))
    with_center = tested.select(F.col("a").alias("center"), F.col("b").alias("rep"), "common")
    open_rows = live.filter("members > 2").join(with_center, ["center", "rep"], "left")
    common = F.when(F.col("rep") == F.col("center"), F.col("n")).otherwise(F.col("common")).cast("double")
    open_rows = open_rows.select("key", "slot", "rep", "n", common.alias("common"))
    found = None
    for turn in range(STAR_ROUNDS):
        found = stored(connected_components(edges, "a", "b"), "components")
        open_rows = stored(_still_open(open_rows, found, total), "open")
        if open_rows.isEmpty():
            break
        if turn + 1 < STAR_ROUNDS:
            order = F.struct(F.xxhash64("rep", F.lit(turn)), F.col("rep"), F.col("n"), F.col("common"), F.col("comp"))
            centers = open_rows.groupBy("key").agg(F.min(order).alias("c"), F.count(F.lit(1)).alias("in_key"))
            across = split_join(open_rows, stored(centers, "centers"), ["key"], "in_key", total, HOT_BUCKET)
            across = across.filter((F.col("comp") != F.col("c.comp")) & _sizes_fit("n", "c.n", percent))
            reach = _can_reach(F.col("n"), F.col("c.n"), F.col("common"), F.col("c.common"), F.least, percent)
            unknown = F.col("common").isNull() | F.col("c.common").isNull()
            across = across.filter(unknown | reach)
            fresh = across.select(F.least("rep", "c.rep").alias("a"), F.greatest("rep", "c.rep").alias("b")).distinct()
            fresh = within_radius(fresh.join(tested, ["a", "b"], "left_anti"), classes)
        else:
            with_sig = open_rows.join(classes.select("rep", "sig", "sketch"), "rep")
            fresh = block_pairs(with_sig, percent, total).join(tested, ["a", "b"], "left_anti")
        fresh = stored(measured(stored(fresh, "pairs"), texts, width, percent), "tested")
        tested = tested.union(fresh)
        edges = edges.union(fresh.filter("linked").select("a", "b"))
    if not open_rows.isEmpty():
        found = stored(connected_components(edges, "a", "b"), "components")

    placed = stored(
        classes.join(found, F.col("rep") == F.col("id"), "left")
        .filter((F.col("members") > 1) | F.col("component").isNotNull())
        .select("set_hash", F.coalesce("component", "rep").alias("component_id")),
        "placed",
    )
    component = F.coalesce("component_id", "doc_id")
    return rows.join(placed, "set_hash", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def first_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component; cases as in `near_duplicates`.

    Rows that repeat a doc_id stay or go together; rows without one stay.
    """
    gone = near_duplicates(docs, width, percent).filter(~F.col("kept")).select("doc_id").distinct()
    gone = stored(gone.withColumnRenamed("doc_id", "gone_id"), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def _still_open(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """(key, slot, rep, n, common, comp) of the buckets that hold more than one component."""
    at = rows.select("key", "slot", "rep", "n", "common").join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
    at = at.withColumn("comp", F.coalesce("component", "rep")).drop("component")
    at = stored(at, "placed-rows")
    mixed = at.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("in_key"))
    return split_join(at, mixed.filter("x <> y").select("key", "in_key"), ["key"], "in_key", total, HOT_BUCKET)


def oracle(docs: str = "documents", width: int = 5, percent: int = 80) -> str:
    """(doc_id, n_shingles, component_id, kept) in SQL, over all pairs that share a shingle."""
    parts = " || ' ' || ".join(f"w[p + {k}]" for k in range(width))
    return f"""
    WITH RECURSIVE tokens AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {docs}),
    shingles AS (
      SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, {parts} AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS p FROM tokens) a
        UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM tokens WHERE len(w) BETWEEN 1 AND {width - 1}) b),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
      SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM shingles x JOIN shingles y ON x.s = y.s
        WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) p
      JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * i >= {percent} * (m.n + n.n - i)),
    reach(id, other) AS (
      SELECT doc_id, doc_id FROM {docs} UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a)
    SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
    FROM {docs} d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) c ON c.id = d.doc_id"""
