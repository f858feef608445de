"""The additive model against trying everything, the fingerprints' radius, and the licence list."""

import numpy as np
import pytest

from siteplan.llm import decontaminate, license_scan, quality_model
from siteplan.llm.quality_model import FEATURES, Gam, _cross, _split, _tree, fit


def gain(g, h):
    return g.sum() ** 2 / (h.sum() + 1.0)


def drawn(seed, *shape):
    draw = np.random.default_rng(seed)
    return draw.normal(size=shape), draw.random(shape) + 0.05


@pytest.mark.parametrize("seed", range(20))
def test_split_is_the_best_of_all_cuts(seed):
    g, h = drawn(seed, 2 + seed % 7)
    gains = [gain(g[:c], h[:c]) + gain(g[c:], h[c:]) - gain(g, h) for c in range(1, len(g))]
    found, cut = _split(g, h)
    assert found == pytest.approx(max(gains)) and cut == 1 + int(np.argmax(gains))


def test_split_of_one_bin_is_none():
    assert _split(np.ones(1), np.ones(1)) == (0.0, 0)


@pytest.mark.parametrize("seed", range(20))
def test_tree_is_the_best_cut_and_the_best_cut_of_its_sides(seed):
    g, h = drawn(seed, 9)
    cut = max(range(1, 9), key=lambda c: gain(g[:c], h[:c]) + gain(g[c:], h[c:]))
    sides = [(0, cut), (cut, 9)]
    inner = [
        (gain(g[a:m], h[a:m]) + gain(g[m:b], h[m:b]) - gain(g[a:b], h[a:b]), a, m, b) for a, b in sides for m in range(a + 1, b)
    ]
    more, a, m, b = max(inner)
    leaves = [s for s in sides if s != (a, b)] + [(a, m), (m, b)] if more > 0 else sides  # a second cut must gain
    want = np.zeros(9)
    for a, b in leaves:
        want[a:b] = -g[a:b].sum() / (h[a:b].sum() + 1.0)
    assert _tree(g, h) == pytest.approx(want)


@pytest.mark.parametrize("seed", range(20))
def test_cross_is_the_best_of_all_cuts_of_two_features(seed):
    g, h = drawn(seed, 5, 4)
    best, want = -1.0, None
    for r in range(1, 5):
        for c in range(1, 4):
            parts = [(slice(0, r), slice(0, c)), (slice(0, r), slice(c, 4)), (slice(r, 5), slice(0, c)), (slice(r, 5), slice(c, 4))]
            total = sum(gain(g[p], h[p]) for p in parts) - gain(g, h)
            if total > best:
                best, want = total, np.zeros((5, 4))
                for p in parts:
                    want[p] = -g[p].sum() / (h[p].sum() + 1.0)
    found, values = _cross(g, h)
    assert found == pytest.approx(best) and values == pytest.approx(want)
    assert _cross(g[:1], h[:1])[0] == 0.0


def by_hand(model: Gam, row) -> float:
    """One row's score: a bin found by counting the edges not above the value, table by table."""
    total = model.bias
    for edges, values, v in zip(model.edges, model.tables, row):
        total += values[sum(v >= e for e in edges)]
    for (i, j), values in zip(model.pairs, model.pair_tables):
        total += values[sum(row[i] >= e for e in model.coarse[i]), sum(row[j] >= e for e in model.coarse[j])]
    return 1 / (1 + np.exp(-total))


def test_scores_are_the_sums_of_looked_up_values():
    draw = np.random.default_rng(3)
    x = draw.random((400, len(FEATURES))).round(2)  # many values equal an edge
    # two features count alone, two only together
    y = ((x[:, 0] > 0.6) | ((x[:, 4] > 0.5) == (x[:, 7] > 0.5)) & (x[:, 2] < 0.7)).astype(float)
    model = fit(x, y)
    assert (4, 7) in model.pairs
    assert model.score(x) == pytest.approx([by_hand(model, row) for row in x])
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


def test_score_query_sums_tables_of_the_model_fitted_on_the_drawn_rows(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    draw = np.random.default_rng(6)
    rows = [(i, " ".join(draw.choice(words, 20 + i % 50)) + (" !!!! $$$$ ####" * 5 if i % 3 == 0 else ".")) for i in range(120)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id long, quality int")
    model = fit(*quality_model.train_rows(quality_model.feature_table(docs), labels, "quality", 1000))
    classes, known = quality_model.char_classes(), quality_model._WordHashes()
    want = {i: by_hand(model, quality_model.text_features(t, classes, known)) for i, t in [*rows, (500, None), (501, "")]}
    got = {r["doc_id"]: r["score"] for r in quality_model.score_quality(docs, labels).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("n", [5, 9, 18, 45])
@pytest.mark.parametrize("over_the_end", [False, True])
def test_fingerprint_radius(n, over_the_end):
    """How often an item and a window at the least similarity lie further apart than RADIUS."""
    draw = np.random.default_rng(n)
    if over_the_end:  # the window is a part of the item
        common, rest = -(-8 * n // 10), 0
    else:  # as long as the item
        common = -(-8 * n // 9)
        rest = n - common
    ones = lambda k: draw.binomial(k, 0.5, (40_000, 64))
    both = ones(common)
    item, window = both + ones(n - common), both + ones(rest)
    apart = ((2 * item > n) != (2 * window > common + rest)).sum(axis=1)
    lost = (apart > decontaminate.RADIUS).mean()
    assert lost < (0.01 if over_the_end and n == 5 else 0.001)


def test_each_licence_is_found_in_a_text_that_holds_it(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    names = sorted(license_scan.TEMPLATES)
    docs = spark.createDataFrame(
        [(i, f"{filler} {license_scan.TEMPLATES[name].upper()} {filler}") for i, name in enumerate(names)], "doc_id long, text string"
    )
    found = {(r["doc_id"], r["license_id"]): r["containment"] for r in license_scan.license_scan(docs).collect()}
    assert all(found[i, name] == 1.0 for i, name in enumerate(names))
    # the shorter wordings of one licence lie inside the longer; versions differ by a word
    others = {(names[i], other) for i, other in found if names[i] != other}
    assert all(a.split("-")[0].lstrip("AL") == b.split("-")[0].lstrip("AL") for a, b in others)
