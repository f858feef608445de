"""Prefix trie, sharding and ranked search against brute force, with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteplan.llm import lexical_search, prefix_trie, radix, ranges, sharding

CLASH = ["a", "b", "part", "at", "place", "key", "level", "h", "m", "terms", "item", "size", "shard", "n"]


def clashing(frame):
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASH])


# ---- radix tree


@pytest.mark.parametrize("fan", [3, 12, 40, 200])
def test_radix_tree_layouts(fan):
    draw = random.Random(fan)
    firsts = [bytes([draw.randrange(256)]) + draw.randbytes(3) for _ in range(fan)]
    keys = [b"".join(draw.choices(firsts, k=draw.randint(1, 5))) for _ in range(600)]
    tree = radix.RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, key, [1, i], i, [i])
    got = {}
    for depth, node, end in tree.aligned(4):
        got[node.row[: 4 * depth]] = (node.sums, node.least, sorted(node.ends or []) if end else [])
    want = {}
    for key in keys:
        for d in range(4, len(key) + 1, 4):
            p = key[:d]
            if p not in want:
                below = [i for i, k in enumerate(keys) if k.startswith(p)]
                want[p] = ([len(below), sum(below)], min(below), [i for i in below if keys[i] == p])
    assert got == want


# ---- trie


def brute_trie(rows, family=100, most=6):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), key, (role, text)))
    turns = {c: [t for *_, t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, family)), [])[:h] + ts[h:])
    nodes = {s[:d] for s in rebuilt.values() for d in range(len(s) + 1)}
    members = {n: sorted(c for c, s in rebuilt.items() if s[: len(n)] == n) for n in nodes}
    children = Counter(n[:-1] for n in nodes if n)
    out = set()
    for n in nodes:
        below = [x for x in nodes if x[: len(n)] == n]
        saved = sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below)
        ends = ",".join(str(c) for c in members[n] if rebuilt[c] == n)
        out.add(
            (
                members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), children[n],
                sum(1 for x in below if not children[x]), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


TURNS = "conv_id long, turn long, role string, text string"


def trie_rows(spark, rows):
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    got = prefix_trie.prefix_trie(clashing(frame)).collect()
    names = prefix_trie.OUT.replace(" long", "").replace(" string", "").split(", ")
    out = [tuple(r[c] for c in names) for r in got]
    assert len(out) == len(set(out))
    return set(out)


def test_trie_cases(spark):
    rows = [
        (None, 1, "user", "lost"),
        (0, 1, "user", "hi"), (0, None, "system", None), (0, 2, None, "é" * 5), (0, 2, None, "é" * 5), (0, 3, "u", "x"),
        (0, 4, "u", "y"), (0, 5, "u", "z"),
        (1, 1, "user", "hi"), (2, 1, "user", "hi"), (3, 1, "", ""), (3, 2, None, None),
        (205, 0, "user", "alone"), (206, 0, "user", "long " * 50_000), (206, 1, "a", "b"), (-7, 0, "user", "hi"), (-7, 1, "q", "r"),
    ]
    rows += [(c, 0, "user", "hi") for c in range(300, 340)] + [(c, t, "user", f"t{t}") for c in range(400, 420) for t in range(9)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_long_conversations_cross_segments(spark, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 4)
    draw = random.Random(5)
    rows = []
    for c in range(60):  # long shared beginnings that part before, at and behind the segments' ends
        cut = draw.choice([31, 32, 33, 64, 200])
        rows += [(c, t, "u", f"same {t}" if t < cut else f"{c % 3} {t}") for t in range(draw.choice([32, 64, 65, 300]))]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_small_trees_and_chunks_agree(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TREE_KEYS", 5)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    rows = [(c, t, "user", f"t{t} {c % 4 if t > 1 else ''}") for c in range(700) for t in range(3)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_turnless_and_empty(spark):
    turnless = [c for c in range(500, 600) if zlib.crc32(str(c).encode()) % 6 >= 1 and c % 100][:3]
    rows = [(c, 1, "user", "gone") for c in turnless]
    assert trie_rows(spark, rows) == brute_trie(rows)
    assert trie_rows(spark, rows[:0]) == set()


# ---- shards

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("rows", [1, 2, 3, 16, 17, 1000, 65_537])
def test_permutation_and_inverse(rows):
    placed = sharding.permute(np.arange(rows), rows, "seed")
    assert sorted(placed) == list(range(rows))
    assert (sharding.unpermute(placed, rows, "seed") == np.arange(rows)).all()


def test_permutation_spreads():
    placed = sharding.permute(np.arange(24_000), 24_000, "seed")
    for block in placed.reshape(24, 1000):  # neighbours spread over shards, and no shard is preferred
        assert max(np.bincount(block % 24, minlength=24)) < 90
    other = sharding.permute(np.arange(24_000), 24_000, "other")
    assert (placed == other).mean() < 0.01


def test_shards(spark):
    texts = [None, "", "a", "é\n" * 3, "word " * 100_000]
    rows = [(i % 50 if i % 7 else None, texts[i % 5]) for i in range(400)] + [(1, "copy")] * 300
    frame = clashing(spark.createDataFrame(rows, DOCS)).repartition(6)
    got = sharding.assign_shards(frame, shards=7).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} == {100}
    again = sharding.assign_shards(frame.repartition(3), shards=7).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, got)) == sorted(map(key, again))
    # the row number behind a shard and slot
    numbers = sharding.unpermute(np.array([r["slot"] * 7 + r["shard"] for r in got]), len(got), "shards")
    ordered = [r["doc_id"] for _, r in sorted(zip(numbers, got), key=lambda x: x[0])]
    assert ordered == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sharding.assign_shards(frame.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"text {i}") for i in range(100)], DOCS).withColumn("lang", F.lit("en"))
    sharding.write_shards(frame, f"file://{tmp_path}/out", shards=5)
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert sorted(back.columns) == ["doc_id", "lang", "shard", "slot", "text"]
    assert back.select("doc_id", "text").distinct().count() == 100
    assert [r["n"] for r in back.groupBy("shard").agg(F.count("*").alias("n")).collect()] == [20] * 5


# ---- search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k=20):
    found = [(i, Counter(WORD.findall((t or "").translate(FOLD)))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    many, total = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = Counter()
    for item_id, text in items:
        scored = []
        for i, c, n in found:
            m = 75 + (25 * n * many) // total
            score = 0
            for t in WORD.findall((text or "").translate(FOLD)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out.update((item_id, rank, i, -s) for rank, (s, *_, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1))
    return out


def search_rows(spark, docs, items, **options):
    docs = clashing(spark.createDataFrame(docs, DOCS)).repartition(6)
    items = clashing(spark.createDataFrame(items, "item_id long, text string")).drop("item").withColumn("item", F.lit(1))
    return Counter(tuple(r) for r in lexical_search.ranked_search(docs, items, **options).collect())


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "naïve", "x1"]
    text = lambda most: " ".join(draw.choices(vocabulary, weights=range(1, 65), k=draw.randint(0, most)))
    docs = [(i, text(60)) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "... ---"), (None, text(30)), (n + 3, text(40_000))]
    docs += [(n + 10 + i, "w60 w61 copy") for i in range(50)] + [(5, "w60 w61 copy")] * 3
    items = [(i, text(25)) for i in range(12)] + [(12, None), (13, ""), (14, "unseen words"), (15, "W60, w60! copy"), (15, "w3"), (None, "w61")]
    return docs, items


def test_search(spark):
    docs, items = corpus(1, 400)
    assert search_rows(spark, docs, items) == brute_search(docs, items)
    assert search_rows(spark, docs[:0], items) == search_rows(spark, docs, items[:0]) == Counter()
    assert search_rows(spark, [(1, None)], items) == Counter()


def test_search_in_small_chunks_and_blocks(spark, monkeypatch):
    docs, items = corpus(2, 600)
    monkeypatch.setattr(lexical_search, "CHUNK_DOCS", 7)
    monkeypatch.setattr(lexical_search, "HELD_POSTINGS", 300)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 5)
    monkeypatch.setattr(lexical_search, "SEED_SHARE", 3)
    assert search_rows(spark, docs, items, k=4) == brute_search(docs, items, k=4)


def test_strata_below_the_threshold_are_not_scored(monkeypatch):
    weights = np.array([100, 7])
    strata = [lexical_search.Stratum(m, [m], [[0, 1]], [[1, 1]], weights) for m in range(75, 175)]
    seen = []
    scores = lexical_search.Stratum.scores
    monkeypatch.setattr(lexical_search.Stratum, "scores", lambda self, *a: seen.append(int(self.doc_ids[0])) or scores(self, *a))
    queries = lexical_search.Queries(np.array([0, 2]), np.array([0, 1]), np.array([1, 2]), np.zeros(1, np.int64), 5)
    queries.visit(strata[::-1])
    assert seen == [75, 76, 77, 78, 79] and list(queries.top[0][1]) == seen
