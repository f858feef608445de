"""Nulls, empty and long texts, ties, repeats, empty tables and clashing names, per operator."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from siteplan.llm import (
    decontaminate,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    quality_model,
    token_counts,
    url_filter,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["kept", "pos", "key", "size", "h", "rep", "text_hash", "n_words", "comp", "start", "x", "found", "cut_lines", "line"]


def words(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))


LONG = words(60_000, 1)
PLAIN = words(120, 2)
NEAR = PLAIN + " extra"
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, " \t\n ", "en", "a", 4),
    (4, LONG, "en", "a", len(LONG)),
    (5, PLAIN, "en", "b", len(PLAIN)),
    (5, PLAIN, "en", "b", len(PLAIN)),
    (6, PLAIN, "de", "c", len(PLAIN)),
    (7, NEAR, "en", "b", len(NEAR)),
    (None, PLAIN, "en", None, len(PLAIN)),
    (8, words(80, 3) + "\nshared line\nÉnd", "en", "b", 1),
    (9, words(80, 4) + "\n SHARED Line \t", "en", "b", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    return frame.select("*", *[F.lit("clash").alias(c) for c in CLASH]).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(frame, *columns):
    return sorted(((r["doc_id"], *[r[c] for c in columns]) for r in frame.collect()), key=repr)


def test_quality(docs, none):
    report = {r["doc_id"]: r for r in quality.quality_report(docs).collect()}
    assert [report[i]["n_words"] for i in (1, 2, 3, 4)] == [0, 0, 0, 60_000]
    assert report[1]["base_failed"] and not report[1]["kept"] and report[4]["kept"]
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "5", "5", "6", "7", "8", "9", "None"]
    assert quality.quality_report(none).count() == quality.quality_filter(none).count() == 0


def test_repeated_words(spark):
    texts = ["a b c d a b c", "a b c a b c a b c", "x x x x", "a b", "", "a b c x a b c y a b z"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = [r[0] for r in frame.select(quality.repeated_words(quality.words(F.col("text")))).collect()]

    def brute(text):
        w = text.split()
        g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        return len({i + k for i, x in enumerate(g) if g.count(x) > 1 for k in range(3)})

    assert got == [brute(t) for t in texts]


def test_line_dedup(docs, none):
    out = line_dedup.line_dedup(docs, min_docs=2)
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert set(docs.columns) <= set(out.columns)
    shared = got[8, ROWS[9][1]]
    assert (shared["n_lines"], shared["n_dropped"], shared["kept_text"]) == (3, 1, words(80, 3) + "\nÉnd")
    assert (got[1, None]["kept_text"], got[1, None]["n_lines"], got[2, ""]["n_lines"]) == ("", 1, 1)
    assert got[5, PLAIN]["kept_text"] == "" and got[4, LONG]["kept_text"] == LONG
    assert got[3, " \t\n "]["n_dropped"] == 0  # blank lines have no key
    assert out.count() == len(ROWS) and line_dedup.line_dedup(none).count() == 0


def test_near_duplicates(docs, none):
    out = near_dedup.near_duplicates(docs, width=2)
    assert by_id(out, "n_shingles", "component_id", "kept") == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, len(set(zip(LONG.split(), LONG.split()[1:]))), 4, True),
            (5, 119, 5, True), (5, 119, 5, True), (6, 119, 5, False), (7, 120, 5, False), (None, 119, None, True),
            (8, 82, 8, True), (9, 81, 9, True),
        ],
        key=repr,
    )
    assert near_dedup.first_of_each(docs).columns == docs.columns
    assert near_dedup.near_duplicates(none).count() == 0


def test_decontaminate(spark, docs, none):
    item = " ".join(PLAIN.split()[20:60]).upper()
    rows = [(1, item), (2, None), (3, ""), (4, "one two three four"), (5, "un " + " ".join(PLAIN.split()[1:30])), (6, words(40, 9))]
    items = spark.createDataFrame(rows, "item_id long, text string").withColumn("n", F.lit("clash"))
    found = decontaminate.leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, j) for i in (5, 6, 7, None) for j in (1, 5)}
    starts = {(r["item_id"], r["start"]): round(r["similarity"], 3) for r in found.filter("doc_id = 7").collect()}
    assert starts == {(1, 20): 1.0, (5, 0): round(25 / 27, 3)}
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4, 8, 9]
    assert decontaminate.leaks(none, items).count() == decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_mixing(docs, none):
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(ROWS)
    per = {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        size, target, taken = per.get(r["source"], (r["source_size"], r["target"], 0))
        per[r["source"]] = (size, target, taken + r["taken"])
    total = sum(len((t or "").split()) for _, t, *_ in ROWS)
    assert sum(p[0] for p in per.values()) == total and abs(sum(p[1] for p in per.values()) - total) < 1e-6
    assert all(abs(target - taken) <= 1 for _, target, taken in per.values())
    assert {s: p[1] / p[0] for s, p in per.items() if s != "a"} == {"b": 3.0, "c": 3.0, None: 3.0}
    again = mixing.mix_sources(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    assert mixing.mix_sources(none).count() == 0


def test_token_counts(spark, docs, none):
    own = token_counts.encoder()
    lengths = sorted(len(own.encode_ordinary(t or "")) for _, t, *_ in ROWS)
    table = token_counts.token_counts(docs)
    for r in table.collect():
        limit = r["n_tokens"]
        assert r["kept_tokens"] == sum(min(n, limit) for n in lengths)
        assert r["docs_at_least"] == sum(n >= limit for n in lengths) and r["n_docs"] == lengths.count(limit)
    assert token_counts.quantile(table, 0.5).first()[0] == lengths[(len(lengths) + 1) // 2 - 1]
    assert token_counts.token_counts(none).count() == 0


def test_license_scan(spark, docs, none):
    rows = [(1, None), (2, ""), (3, LONG + " released under the mit-license! " + LONG), (4, "licensed under cc by"), (5, "Licensed under CC BY NC, 4.0")]
    given = spark.createDataFrame(rows, "doc_id long, text string").withColumn("step", F.lit("clash"))
    found = license_scan.license_scan(given)
    assert {(r["doc_id"], r["license_id"], r["start"]) for r in found.collect()} == {
        (3, "MIT-notice", 59_999), (5, "CC-BY-NC-4.0-notice", 0),
    }
    assert license_scan.license_scan(docs).count() == license_scan.license_scan(none).count() == 0
    with pytest.raises(ValueError):
        license_scan.license_scan(docs, {str(i): "x" for i in range(2000)})


PAGES = [
    (1, "http://a.bad.com/x", '<link rel="canonical" href="https://plain.info/p">'),
    (2, "https://plain.info/p#top", None),
    (3, "https://other.info/q?z=1", "<META content='0; URL=/r' http-equiv=refresh>"),
    (4, "https://other.info/r", "<link href='http://good.org/ok' rel=canonical>"),
    (5, "http://GOOD.org/ok", ""),
    (6, None, "<p>"),
    (7, "no scheme", '<link rel=canonical href="http://bad.com/">'),
    (8, "http://mixed.info/1", '<link rel=canonical href="http://bad.com/z"><link rel=canonical href="//good.org/ok">'),
    (9, "http://bad.com/z", ""),
    (10, "http://free.info/", ""),
    (10, "http://free.info/", ""),
]
RULES = [url_filter.Rule("block", "bad.com/"), url_filter.Rule("allow", "good.org/ok")]


def test_url_filter(spark):
    import duckdb

    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("node", F.lit("clash"))
    out = url_filter.judge_urls(pages, RULES)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got[1] == ("a.bad.com", "/x", "bad.com/", "block") and got[2] == ("plain.info", "/p", None, "block")
    assert got[3][3] == got[4][3] == "allow" and got[5] == ("good.org", "/ok", "good.org/ok", "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8][3] == "allow" and got[9][3] == "block" and got[10][3] == "allow" and out.count() == len(PAGES)
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url", "html").toPandas())
    want = con.execute(url_filter.oracle(RULES)).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in out.collect())
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_html_extract(spark):
    page = (
        "<html><head><title>t</title><script>var a='<p>x</p>';</script></head><body><nav><a href='/'>Home</a></nav>"
        "<article><h1>A &amp; B</h1><p>One <b>two<br>three\n four.</p><p>Caf&eacute; &lt;b&gt;<p title=\"a>b\">Last one"
        "<div class='comments'><p>I think so too.</p></div></article><footer>&copy; x</footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<article><p>" + "word " * 200_000 + "</p></art"), (1, "u", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract_main_text(pages).collect()))
    text = "A & B\nOne two three four.\nCafé <b>\nLast one"
    assert got[:2] == [(1, text, len(text))] * 2 and got[2:4] == [(2, "", 0), (3, "", 0)]
    assert got[4][1] == ("word " * 200_000).strip()
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


ALIASES = [
    ("http://a.org/x/y?p#f", "b?a=1&amp;b=2", "a.org/x/b?a=1&b=2"),
    ("http://a.org/x/y", "/q?a=1&#38;b=2&#x26;c=3&d=4", "a.org/q?a=1&b=2&c=3&d=4"),
    ("http://a.org/x/y", "/q?a&#38;amp;b&amp=1&copy=2&#233;&#x1F600;&#150;&#0;&#xD800;&#99999999999999999999;", "a.org/q?a&amp;b&amp=1&copy=2é😀–\ufffd\ufffd\ufffd"),
    ("http://a.org/x/y/z", "./b", "a.org/x/y/b"),
    ("http://a.org/x/y/z", "../b?q=/../c", "a.org/x/b?q=/../c"),
    ("http://a.org/x/y/z", "../../../../b", "a.org/b"),
    ("http://a.org/x/y/z", "..", "a.org/x/"),
    ("http://a.org/x/y/z", ".", "a.org/x/y/"),
    ("http://a.org/x/y/z", "/m/./n/%2E%2e/o.html", "a.org/m/o.html"),
    ("http://a.org/x/y/z", "https://B.org/m/../n#f", "b.org/n"),
    ("http://a.org/x/y/z", "..b/.c", "a.org/x/y/..b/.c"),
    ("http://a.org/x/y?p=1#f", "?x=2", "a.org/x/y?x=2"),
    ("http://a.org/x/y?p=1#f", "#g", "a.org/x/y?p=1"),
    ("http://a.org", "b", "a.org/b"),
    ("http://a.org/x/../y", "http://a.org/z", "a.org/z"),
]


def test_url_aliases(spark):
    rows = [(u, f'<link rel="canonical" href="{h}">') for u, h, _ in ALIASES] + [(u, f'<meta http-equiv="refresh" content="0; url={h}">') for u, h, _ in ALIASES]
    edges = url_filter.alias_edges(spark.createDataFrame(rows, "url string, html string").coalesce(1)).collect()
    assert [r["b"] for r in edges] == [b for *_, b in ALIASES] * 2 and edges[len(ALIASES) - 1]["a"] == "a.org/y"


def test_url_alias_takes_the_decision(spark):
    rows = [(1, "http://bad.com/p?a=1&b=2", ""), (2, "http://free.info/1", '<link rel=canonical href="//bad.com/x/../p?a=1&amp;b=2">')]
    out = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), [url_filter.Rule("block", "bad.com/p")])
    assert [r["verdict"] for r in out.orderBy("page_id").collect()] == ["block", "block"]


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>x</title><meta charset=utf-8><body><article>{}</article></body></html>",
        "<head><style>p {{}}</style><script>1</script><article>{}</article>",
        "<head><title>x</title><link rel=icon href=i>{}",
        "<head><title>x</title></head><body><div><select><option>One<option>Two<article>{}</article></div></body>",
        "<body><div><svg><g><path d='M0'><article>{}</article></div></body>",
        "<body><div><select><div><option>One</option></div></select><svg><text>Two</text></svg></div>{}</body>",
        "<body><svg><foreignObject><p>One</p></foreignObject></svg>{}</body>",
        "<html><head><title>x</title></head><body>{}</body></html>",
    ],
)
def test_open_hidden_elements(page):
    blocks = [b.text for b in html_extract.leaf_blocks(page.format("<h1>Title</h1><p>One <b>two</b>.</p><p>Three</p>"))]
    assert blocks == ["Title", "One two.", "Three"]


def test_page_without_end_of_head(spark):
    assert [b.text for b in html_extract.leaf_blocks("<head><title>x</title>Text <b>more")] == ["Text more"]
    page = "<html><head><title>x</title><body><article><h1>Title</h1><p>One two three four five.</p></article></body></html>"
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert html_extract.extract_main_text(pages).first()["text"] == "Title\nOne two three four five."


def test_html_held_out():
    model, wrong, total = html_extract.train(), 0, 0
    for page in html_extract.labelled_pages(150, seed=77):
        blocks = html_extract.leaf_blocks(page)
        chosen = model.decode([html_extract.block_features(b) for b in blocks])
        wrong += sum(c != any(e.main for e in b.path) for b, c in zip(blocks, chosen))
        total += len(blocks)
    assert wrong / total < 0.02


def test_quality_model(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, None), (4, 1), (5, 1), (99, 1)], "doc_id long, quality int").withColumn("x", F.lit("clash"))
    out = quality_model.score_quality(docs, labels)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    import zlib

    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    prior = quality_model.score_quality(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in prior] == [0.5]
    assert quality_model.score_quality(none, labels).count() == 0


def test_hash_of_kept_text(docs):
    row = line_dedup.line_dedup(docs).filter("doc_id = 4").select(F.sha2("kept_text", 256)).first()
    assert row[0] == hashlib.sha256(LONG.encode()).hexdigest()


@pytest.mark.parametrize("hot", [near_dedup.HOT_BUCKET, 4])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, hot):
    """Families of copies at every distance, in small blocks, with a poor first member; buckets whole and cut into parts."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "HOT_BUCKET", hot)
    draw = random.Random(12)
    texts = []
    for family in range(4):
        base = [f"w{family}x{draw.randrange(400)}" for _ in range(60)]
        for copy in range(30):
            changed = list(base)
            for at in draw.sample(range(60), 4 if copy == 0 else draw.choice([0, 1, 1, 2, 2, 3, 4, 5])):
                changed[at] = f"new{draw.randrange(10**6)}"
            texts.append(" ".join(changed))
    order = list(range(len(texts)))
    draw.shuffle(order)
    docs = spark.createDataFrame([(i, texts[k]) for i, k in enumerate(order)], "doc_id long, text string").repartition(5)
    sets = [set(zip(t.split(), t.split()[1:])) for t in (texts[k] for k in order)]
    least = list(range(len(sets)))
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in range(len(sets)):
        for i, j in linked:
            least[i] = least[j] = min(least[i], least[j])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, width=2).collect()}
    assert [got[i] for i in range(len(sets))] == least and 4 < len(set(least)) < len(sets)
