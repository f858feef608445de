"""Texts and keys that once broke an operator: blank and endless texts, unclosed pages, nodes and ids of a third of the rows."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siteplan.llm import dom, graph, html_extract, line_dedup, mixing, quality, ranges, token_counts, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], SCHEMA)


# ---- quality rules


@pytest.mark.parametrize("texts", [[None] * 40, [" \t\n"] * 40, [""] * 3 + [None] * 3, ["word"]])
def test_quality_of_blank_tables(spark, texts):
    report = quality.quality_report(frame_of(spark, texts)).collect()
    assert [r["kept"] for r in report] == [False] * len(texts)
    assert {r["n_words"] for r in report} == ({1} if texts == ["word"] else {0})
    assert quality.quality_filter(frame_of(spark, texts)).count() == 0


def test_every_order_of_rules_keeps_the_same(spark):
    good = " ".join(f"wort{i} und" for i in range(40))
    frame = frame_of(spark, [None, "", " \n", "x", good, "a " * 200, "#" * 300, "!" * 90, "a" * 10**6, " " * 10**6, good.upper()])
    frame = frame.withColumn("q", F.struct(quality.whole_text().alias("text"), quality.words(quality.whole_text()).alias("ws"))).cache()
    rules = quality.base_rules() + quality.text_rules()
    turned = [rules[i:] + rules[:i] for i in range(len(rules))]
    for order in turned + [r[::-1] for r in turned]:
        rejected = frame.select("doc_id", quality.cascade(order, F.col("q.text"), F.col("q.ws")).alias("out"))
        assert [r["doc_id"] for r in rejected.filter("not out").collect()] == [4]


# ---- token counts


def test_tokens_around_long_runs_of_space():
    count, own = token_counts.token_counter(), token_counts.encoder()
    draw = random.Random(4)
    for _ in range(200):
        parts = []
        for _ in range(draw.randint(1, 5)):
            parts.append("".join(draw.choices(["a", "b ", "1", "!", "'s", " x", "é", "\n", "\x1c", "\x85"], k=draw.randint(0, 6))))
            parts.append(draw.choice([" ", "\n", "　"]) * draw.choice([0, 1, 2, 999, 1000, 1001, 2500]) + draw.choice(["", " ", "\t"]))
        text = "".join(parts)
        assert count(text) == len(own.encode_ordinary(text))


@pytest.mark.parametrize("one", [" ", "\n", "a", "!", " \n", "é"])
@pytest.mark.parametrize("n", [10**6, 10**7])
def test_tokens_of_endless_texts(one, n):
    count = token_counts.token_counter()
    assert 0 < count(one * n) <= len((one * n).encode())


def test_token_lengths_of_blank_texts(spark):
    rows = token_counts.encoded_lengths(frame_of(spark, [None, "", " " * 10**6, "\t" * 10**6 + "x"])).collect()
    assert [r["n_tokens"] for r in sorted(rows, key=lambda r: r["doc_id"])][:2] == [0, 0] and all(r["n_tokens"] > 0 for r in rows if r["doc_id"] > 1)


# ---- pages


@pytest.fixture(scope="module")
def model():
    return html_extract.train()


@pytest.mark.parametrize("one", ["<div><span>some text", "<section><b>x", "<p><button><section>x", "<svg><g>x<div>", "<ul><li>x<ul>", "<a>x"])
def test_unclosed_pages_take_linear_time(model, one):
    html_extract.main_text(one * 1000, model)

    def took(n):
        start = time.perf_counter()
        html_extract.main_text(one * n, model)
        return time.perf_counter() - start

    assert took(40_000) < 12 * max(took(10_000), 0.05)  # 16 times if it were quadratic


def test_signs_are_found_anywhere_and_prose_may_hold_them():
    short = html_extract.block_features(dom.leaf_blocks("<p>" + "x" * 500 + " all rights reserved</p>")[0])
    assert "sign=all rights reserved" in short
    prose = html_extract.block_features(dom.leaf_blocks("<p>" + "word " * 100 + "share a comment</p>")[0])
    assert not [f for f in prose if f.startswith("sign=")] and "long sign=share" in prose


def test_prose_with_signs_stays_main(model):
    prose = ("The committee asked members to share a comment on privacy, cookies and how to subscribe. " * 8).strip()
    page = f"<html><body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{prose}</p></article><footer>© Someone</footer></body></html>"
    assert html_extract.main_text(page, model) == f"Title\n{prose}"


#: Layouts and class words that the labelled pages do not have.
UNSEEN = [
    '<body><div id="top-navigation"><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><main><section><h1>{0}</h1><p>{1}</p><p>{2}</p></section></main><div id="bottom"><p>Imprint</p></div></body>',
    '<body><header><p>Daily</p></header><div class="story"><h1>{0}</h1><p>{1}</p><div class="sponsor"><p>Buy now.</p></div><p>{2}</p></div><div class="disqus"><p>Nice.</p></div></body>',
    '<body><table><tr><td><a href=/a>One</a> <a href=/b>Two</a></td></tr></table><article><h1>{0}</h1><p>{1}</p><p>{2}</p></article><aside><p>Most read</p></aside></body>',
    '<body><div class="toolbar"><a href=/a>One</a></div><article class="prose"><h1>{0}</h1><div><p>{1}</p></div><div><p>{2}</p></div></article><div class="recommended"><a href=/c>Else</a></div></body>',
]


@pytest.mark.parametrize("layout", UNSEEN)
def test_unseen_layouts_and_words(model, layout):
    parts = ["Over the hills", "The first paragraph tells what happened on that day in the valley.", "A second one goes on about it at some length, and ends."]
    assert html_extract.main_text(layout.format(*parts), model) == "\n".join(parts)


# ---- hot keys


def test_component_of_a_hot_node(spark, monkeypatch):
    """A star of half of all edges: no part of a cut node has more rows than allowed, other nodes are not repeated."""
    monkeypatch.setattr(ranges, "HOT_ROWS", 100)
    star = spark.range(1, 20_001).select(F.lit(0).cast("long").alias("x"), F.col("id").alias("y"))
    rest = spark.range(20_001).select((F.col("id") * 2 + 10**6).alias("x"), (F.col("id") * 2 + 10**6 + 1).alias("y"))
    edges = star.union(rest)
    found = graph.connected_components(edges, "x", "y")
    got = found.groupBy("component").count().groupBy("count").agg(F.count("*").alias("n")).collect()
    assert {(r["count"], r["n"]) for r in got} == {(20_001, 1), (2, 20_001)}
    keyed = edges.groupBy("x").agg(F.count("*").alias("degree"), F.min("y").alias("m"))
    joined = ranges.split_join(edges, keyed, ["x"], "degree", edges.count())
    assert joined.count() == edges.count() and joined.filter("m > y").count() == 0


def test_split_join_cuts_by_count(spark):
    rows = spark.range(1_000_000).select(F.when(F.col("id") < 400_000, 0).otherwise(F.col("id")).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"))
    plan = ranges.split_join(rows, keyed, ["k"], "n", 1_000_000)
    assert plan.count() == 1_000_000
    most = -(-400_000 // ranges.HOT_ROWS)
    dealt = rows.filter("k = 0").select(F.pmod(F.xxhash64("k", "id"), F.lit(most)).alias("p")).groupBy("p").count().collect()
    assert len(dealt) == most and max(r["count"] for r in dealt) < 1.2 * ranges.HOT_ROWS


def test_frequent_line_of_most_documents(spark, monkeypatch):
    monkeypatch.setattr(ranges, "HOT_ROWS", 50)
    frame = frame_of(spark, [f"Common\nown {i}\nCommon" for i in range(2000)])
    out = line_dedup.line_dedup(frame).collect()
    assert {(r["n_lines"], r["n_dropped"]) for r in out} == {(3, 2)} and all(r["kept_text"] == f"own {r['doc_id']}" for r in out)


def test_mix_of_rows_without_id_spreads(spark):
    rows = [(None, "w " * (1 + i % 5), "en", "a", 0) for i in range(3000)] + [(7, "same words here", "en", "b", 0)] * 3000
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    out = mixing.mix_sources(frame)
    by = {r["source"]: r for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("size").alias("size")).collect()}
    assert all(abs(r["taken"] - r["target"]) <= 1 for r in by.values()) and sum(r["taken"] for r in by.values()) == sum(r["size"] for r in by.values())
    again = mixing.mix_sources(frame.repartition(3))
    key = lambda r: tuple(map(str, r))
    assert Counter(map(key, out.collect())) == Counter(map(key, again.collect()))


def test_targets_of_many_sources(spark):
    sizes = [(f"s{i:04}", 0, (i * 7919) % 1000, 1) for i in range(3000)]
    frame = spark.createDataFrame(sizes, "src string, no_src int, source_size long, n_rows long").repartition(5)
    got = {r["src"]: r["target"] for r in mixing.source_targets(frame, (5, 2, 1), 3).collect()}
    weight, size = {s: (5, 2, 1)[i % 3] for i, (s, *_) in enumerate(sizes)}, {s: n for s, _, n, _ in sizes}
    share, left, open_ = {}, float(sum(size.values())), set(size)
    while True:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 3 * size[s]}
        if not full:
            break
        share.update({s: 3.0 * size[s] for s in full})
        left -= sum(3 * size[s] for s in full)
        open_ -= full
    share.update({s: left * weight[s] / sum(weight[x] for x in open_) for s in open_})
    assert max(abs(got[s] - share[s]) for s in size) < 1e-6


def test_pages_without_address(spark):
    rows = [(i, None if i % 2 else "no address", "<p>") for i in range(500)] + [(1000, "http://a.net/", "")]
    out = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), [url_filter.Rule("block", "net/")])
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got.pop(1000)[3] == "block" and set(got.values()) == {("", "", None, "allow")} and len(got) == 500
