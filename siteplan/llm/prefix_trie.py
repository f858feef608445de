"""Conversation prefix trie: adaptive radix trees over fixed-width turn ids, merged across ranges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .crc import TABLE, crc32_sql
from .radix import RadixTree
from .ranges import in_order, part_starts, running_before

#: Bytes of a turn id, big-endian, and turns of one segment; a key has at most 512 bytes.
ID_BYTES = 16
SEGMENT = 32
#: Keys after which a task emits its tree and begins another.
TREE_KEYS = 100_000
#: Ids of one chunk of a node's ends, about 4 KB of text.
CHUNK_IDS = 400
ROWS_OUT = 4096

TREE_ROWS = "a long, b long, depth long, up_a long, up_b long, chars long, s0 long, s1 long, least long, first_end long, ids string"


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of a (role, text)."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))


def numbered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, id, chars) of the table's turns with a conv_id, positions from 1, and (conv_id, n_turns).

    Positions come from a global sort by ranges, so a conversation of any length spreads.
    """
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    slim = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        turn_id(role, text).alias("id"),
        F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = in_order(stored(slim, "turns"), ["conv_id", "turn", "id", "place"], "turn-order")
    spans = stored(part_starts(ordered, "conv_id"), "turn-spans")
    pos = F.col("before") + F.col("at") - F.col("first_at") + 1
    numbered = ordered.join(spans, ["conv_id", "part"]).select("conv_id", pos.alias("pos"), "id", "chars")
    return numbered, spans.groupBy("conv_id").agg(F.sum("rows").alias("n_turns"))


def rebuilt_turns(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, id, chars) of the rebuilt turns, and (conv_id, n_turns) of every rebuilt conversation.

    Conversation c takes the first h turns of c - c % family and then its own after the
    first h, h = crc32(c in decimal) % most.
    """
    numbered, counts = numbered_turns(turns)
    numbered = stored(numbered, "numbered")
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = counts.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.col("n_turns").alias("n_base"))
    convs = (
        counts.withColumn("base", base)
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
        .join(heads, "base", "left")
        .withColumn("n_head", F.least("h", F.coalesce("n_base", F.lit(0))))
    )
    convs = stored(
        convs.select(
            "conv_id", "base", "h", "n_head",
            (F.col("n_head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"),
        ),
        "convs",
    )
    tails = numbered.join(convs.select("conv_id", "h", "n_head"), "conv_id").filter(F.col("pos") > F.col("h"))
    tails = tails.select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("d"), "id", "chars")
    first = numbered.filter((F.col("conv_id") % family == 0) & (F.col("pos") < most))
    first = first.select(F.col("conv_id").alias("base"), "pos", "id", "chars")
    shared = convs.select("conv_id", "base", "n_head").join(first, "base").filter(F.col("pos") <= F.col("n_head"))
    shared = shared.select("conv_id", F.col("pos").alias("d"), "id", "chars")
    return shared.union(tails), convs.select("conv_id", "n_turns")


def segments(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per conversation and SEGMENT turns: level, the fingerprint (a, b) of all turns before, key, and arrays per turn.

    A prefix's fingerprint is the exclusive or of 128-bit hashes of (depth, turn id), so it
    is found for any depth without following the conversation.
    """
    level = F.floor((F.col("d") - 1) / SEGMENT)
    turn = F.struct(
        "d", "id", "chars", F.xxhash64("d", "id").alias("a"), F.xxhash64(F.lit(1), "d", "id").alias("b")
    )
    cut = turns.groupBy("conv_id", level.alias("level")).agg(
        F.array_sort(F.collect_list(turn)).alias("own"),
        F.bit_xor(F.xxhash64("d", "id")).alias("own_a"),
        F.bit_xor(F.xxhash64(F.lit(1), "d", "id")).alias("own_b"),
    )
    cut = stored(cut.join(convs, "conv_id"), "segments")
    short = cut.filter(F.col("n_turns") <= SEGMENT).withColumns({"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long")})
    long = running_before(
        cut.filter(F.col("n_turns") > SEGMENT), "conv_id", "level", {"a": ("bit_xor", "own_a"), "b": ("bit_xor", "own_b")}
    )
    return short.unionByName(long).select(
        "conv_id", "level", "a", "b",
        F.array_join(F.transform("own", lambda t: F.hex(t["id"])), "").alias("hex"),
        F.transform("own", lambda t: t["a"]).alias("turn_a"),
        F.transform("own", lambda t: t["b"]).alias("turn_b"),
        F.transform("own", lambda t: t["chars"]).alias("chars"),
        (F.col("level") == F.floor((F.col("n_turns") - 1) / SEGMENT)).alias("last"),
    ).withColumn("key", F.unhex("hex")).drop("hex")


def _prefixes(row: dict) -> tuple[list[int], list[int]]:
    """Fingerprints of the prefixes of a segment, that of the turns before it first."""
    return tuple(
        np.bitwise_xor.accumulate(np.array([row[x], *row[f"turn_{x}"]], dtype=np.int64)).tolist() for x in "ab"
    )


def _tree_rows(tree: RadixTree, chunk: int) -> Iterator[tuple]:
    prints: dict[int, tuple] = {}
    for k, node, own_end in tree.aligned(ID_BYTES):
        row = node.row
        if id(row) not in prints:
            prints[id(row)] = _prefixes(row)
        a, b = prints[id(row)]
        depth = row["level"] * SEGMENT + k
        if own_end and node.ends:
            for i in range(0, len(node.ends), chunk):
                ids = node.ends[i : i + chunk]
                yield a[k], b[k], depth, None, None, None, None, None, None, ids[0], ",".join(map(str, ids))
        yield a[k], b[k], depth, a[k - 1], b[k - 1], row["chars"][k - 1], *node.sums, node.least, None, None


def tree_rows(ordered: DataFrame, with_ends: bool) -> DataFrame:
    """Partial trie nodes of every range of sorted segments, and their ends in chunks.

    `ordered` has the segments' columns and s0, s1 to be summed. A task builds one radix
    tree per prefix block in its range (and a new one after TREE_KEYS keys); equal keys
    enter it as one. What is cut by a range's end is emitted by both sides.
    """
    names = ["conv_id", "level", "a", "b", "key", "turn_a", "turn_b", "chars", "last", "s0", "s1"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tree, block, held = RadixTree(), None, None

        def enter():
            if held:
                tree.insert(held["key"], held, held["sums"], held["conv_id"], held["ends"])

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["level"], row["a"], row["b"])
                ends = [row["conv_id"]] if with_ends and row["last"] else []
                if here == block and held["key"] == row["key"] and len(held["ends"]) < TREE_KEYS:
                    held["sums"] = [held["sums"][0] + row["s0"], held["sums"][1] + row["s1"]]
                    held["conv_id"] = min(held["conv_id"], row["conv_id"])
                    held["ends"] += ends
                    continue
                enter()
                if here != block or tree.keys >= TREE_KEYS or (held and len(held["ends"]) >= TREE_KEYS):
                    yield from _tree_rows(tree, CHUNK_IDS)
                    tree, block = RadixTree(), here
                held = row | {"sums": [row["s0"], row["s1"]], "ends": ends}
        enter()
        yield from _tree_rows(tree, CHUNK_IDS)

    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in TREE_ROWS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row in rows(batches):
            out.append(row)
            if len(out) == ROWS_OUT:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return ordered.select(*names).mapInArrow(run, TREE_ROWS)


def ends_hashes(chunks: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): the ids of a node's ends, hashed chunk by chunk in order.

    A SHA-256 must be read in order, so the chunks of one node stream through one task; it
    holds one batch, never a node's ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "ends_sha256"), d)) for d in done])
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("a", "b", "ends_sha256"), (*node, digest.hexdigest())))])

    dealt = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "first_end").select("a", "b", "ids")
    return dealt.mapInArrow(run, "a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (see `rebuilt_turns`).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256. A turn is a (role, text), null taken as empty; turns go by
    `turn` (null first), equal ones by the turn id; repeated rows are turns of their own.
    Rows without a conv_id belong to no conversation. A conversation whose turns all fall
    away is a member of the root only. An empty table has no root and gives no row. Other
    columns are not read. Turns are told apart by 128-bit ids, prefixes by 128-bit prints.

    Conversations are cut into segments of 32 turns, range-sorted by their bytes, and every
    task builds radix trees of its range; ranges cut a hot prefix anywhere, and the parts
    of a node are summed afterwards. Each conversation owns the nodes whose smallest member
    it is; as these are its deepest prefixes, a subtree's total is the total of all members'
    own nodes less what the node's own conversation has above it. A second pass of the
    trees sums those totals, so no step goes level by level. Runs at once, through tables
    in the scratch folder; the driver gets the root's row.
    """
    spark = turns.sparkSession
    rebuilt, convs = rebuilt_turns(turns, family, most)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    if root["conv_id"] is None:
        return spark.createDataFrame([], OUT)
    cut = stored(segments(stored(rebuilt, "rebuilt"), convs), "keys")
    keys = ["level", "a", "b", "key", "conv_id"]

    def ranged(weighed: DataFrame) -> DataFrame:
        return weighed.repartitionByRange(*keys).sortWithinPartitions(*keys)

    ones = cut.withColumns({"s0": F.lit(1).cast("long"), "s1": F.lit(0).cast("long")})
    partial = stored(tree_rows(ranged(ones), True), "trees")
    nodes = partial.filter("ids IS NULL").groupBy("a", "b", "depth").agg(
        F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"),
        ((F.sum("s0") - 1) * F.min("chars")).alias("saved"), F.sum("s0").alias("n_convs"), F.min("least").alias("conv_id"),
    )
    nodes = stored(nodes, "prefixes")
    children = nodes.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "nodes")

    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("s0"), F.count_if(F.col("n_children") == 0).alias("s1"))
    weighed = stored(cut.join(owned.filter("s0 > 0 OR s1 > 0"), "conv_id"), "weighed")
    totals = tree_rows(ranged(weighed), False).groupBy("a", "b").agg(F.sum("s0").alias("below"), F.sum("s1").alias("n_leaves"))

    zero = F.lit(0).cast("long")
    turnless = convs.filter("n_turns = 0").select(
        zero.alias("a"), zero.alias("b"), F.col("conv_id").alias("first_end"), F.col("conv_id").cast("string").alias("ids")
    )
    chunks = partial.filter("ids IS NOT NULL").select("a", "b", "first_end", "ids")
    hashes = stored(ends_hashes(chunks.union(turnless)), "ends")
    no_ends = hashlib.sha256(b"").hexdigest()
    rows = (
        running_before(nodes, "conv_id", "depth", {"above": ("sum", "saved")})
        .join(totals, ["a", "b"], "left")
        .join(hashes, ["a", "b"], "left")
        .select(
            "conv_id", "depth", "up_a", "up_b", "n_convs", "n_children",
            F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
            (F.coalesce("below", F.lit(0)) - F.col("above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
        )
    )
    rows = stored(rows, "trie-rows")
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    deep = rows.filter("depth > 1").join(parents, ["up_a", "up_b"])
    top = rows.filter("depth = 1").withColumn("parent_conv_id", F.lit(root["conv_id"]))
    whole = nodes.agg(
        F.coalesce(F.sum("saved"), zero).alias("saved"),
        F.count_if(F.col("n_children") == 0).alias("leaves"),
        F.count_if(F.col("depth") == 1).alias("tops"),
    ).first()
    own_ends = hashes.filter("a = 0 AND b = 0").first()
    first = spark.createDataFrame(
        [
            (
                root["conv_id"], 0, None, root["n_convs"], whole["tops"], whole["leaves"] or 1, whole["saved"],
                own_ends["ends_sha256"] if own_ends else no_ends,
            )
        ],
        OUT,
    )
    return deep.select(*first.columns).union(top.select(*first.columns)).union(first)


OUT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def oracle(turns: str = "conversations", family: int = 100, most: int = 6) -> str:
    """The same rows in SQL: prefixes as joined turn ids, subtrees by comparing prefixes."""
    return f"""
    WITH t AS MATERIALIZED (
      SELECT conv_id, id, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos
      FROM (SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
                   md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
            FROM {turns} WHERE conv_id IS NOT NULL) a),
    c AS MATERIALIZED (
      SELECT conv_id, conv_id - conv_id % {family} AS base, {crc32_sql('CAST(conv_id AS VARCHAR)')} % {most} AS h
      FROM (SELECT DISTINCT conv_id FROM t) b, {TABLE} x),
    r AS MATERIALIZED (
      SELECT conv_id, id, chars, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d
      FROM (SELECT c.conv_id, 0 AS own, t.pos, t.id, t.chars FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL
            SELECT c.conv_id, 1, t.pos, t.id, t.chars FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h) u),
    p AS MATERIALIZED (
      SELECT conv_id, d, chars, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY d) AS key,
             count(*) OVER (PARTITION BY conv_id) AS last FROM r
      UNION ALL
      SELECT c.conv_id, 0, 0, '', coalesce(n.n, 0) FROM c LEFT JOIN (SELECT conv_id, count(*) AS n FROM r GROUP BY 1) n
        ON c.conv_id = n.conv_id),
    n AS MATERIALIZED (
      SELECT key, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = last), '')) AS ends_sha256
      FROM p GROUP BY key, d),
    k AS MATERIALIZED (
      SELECT n.*, (SELECT count(*) FROM n m WHERE m.depth = n.depth + 1 AND starts_with(m.key, n.key)) AS n_children FROM n),
    s AS (
      SELECT k.key, sum(m.saved) AS saved_tokens, count(*) FILTER (m.n_children = 0) AS n_leaves
      FROM k JOIN k m ON starts_with(m.key, k.key) GROUP BY 1)
    SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves,
           CAST(s.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
    FROM k JOIN s ON k.key = s.key LEFT JOIN k u ON k.depth > 0 AND u.key = left(k.key, 32 * (k.depth - 1))"""
