"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees on one binned feature at a time, boosted in turn, add up to one lookup table per
feature; trees on two features add tables for the strongest pairs. A score is a sum of looked
up values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .near_dedup import _WordHashes, shingle_set

FEATURES = [
    "log_chars", "log_words", "word_length", "symbol_share", "upper_share", "digit_share", "punct_share",
    "bang_share", "bar_share", "other_share", "distinct_words", "distinct_windows", "repeated_lines",
    "log_line_length", "short_lines", "top_word", "log_longest_word", "wide_share",
]

#: At most so many labelled rows are used to fit, chosen by hash; scores cover every row.
MAX_TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 8, 8, 120, 40, 0.15
#: Code points classed one by one; those beyond count as letters of wide scripts.
CLASSED = 0x3000
LOWER_, UPPER_, DIGIT_, SPACE_, SYMBOL_, BANG_, BAR_, PUNCT_, OTHER_, WIDE_ = range(10)


def char_classes() -> np.ndarray:
    """The class of each code point below CLASSED."""
    out = np.full(CLASSED + 1, OTHER_, np.uint8)
    for i in range(CLASSED):
        c = chr(i)
        if c.isupper():
            out[i] = UPPER_
        elif c.isalpha():
            out[i] = LOWER_
        elif c.isdigit():
            out[i] = DIGIT_
        elif c.isspace():
            out[i] = SPACE_
        elif c == "!":
            out[i] = BANG_
        elif c == "|":
            out[i] = BAR_
        elif c in "#*$%&<>@^~=_+\\{}[]`":
            out[i] = SYMBOL_
        elif 32 < i < 127:
            out[i] = PUNCT_
    out[CLASSED] = WIDE_
    return out


def text_features(text: str | None, classes: np.ndarray, known: dict) -> list[float]:
    """The values of FEATURES for a whole text; zeros for a null or empty one."""
    text = text or ""
    if not text:
        return [0.0] * len(FEATURES)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    count = np.bincount(classes[np.minimum(points, CLASSED)], minlength=10)
    chars = len(points)
    letters = max(1, count[LOWER_] + count[UPPER_] + count[WIDE_])
    raw = text.encode("utf-8", "replace")
    found = raw.lower().split()
    n = max(1, len(found))
    hashed = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    _, times = np.unique(hashed, return_counts=True) if len(found) else (None, np.zeros(1, np.int64))
    windows = max(1, len(found) - 2)
    distinct = len(shingle_set(text, 3, known))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    full = max(1, len(lines))
    return [
        np.log1p(chars),
        np.log1p(len(found)),
        (chars - count[SPACE_]) / n,
        count[SYMBOL_] / chars,
        count[UPPER_] / letters,
        count[DIGIT_] / chars,
        count[PUNCT_] / chars,
        count[BANG_] / n,
        count[BAR_] / n,
        count[OTHER_] / chars,
        np.count_nonzero(times) / n,
        distinct / windows,
        1 - len(set(lines)) / full,
        np.log1p(len(raw) / full),
        sum(len(line) < 40 for line in lines) / full,
        times.max() / n,
        np.log1p(max(map(len, found), default=0)),
        count[WIDE_] / chars,
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every whole text, text being the only input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, known = char_classes(), _WordHashes()
        for batch in batches:
            rows = [text_features(t.as_py(), classes, known) for t in batch.column("text")]
            x = pa.array([[float(v) for v in r] for r in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), x], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Gam:
    """Bias, bin edges and tables per feature, and tables per pair of coarsely binned features."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of features."""
        total = np.full(len(x), self.bias)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, f], side="right")]
        for (i, j), values in zip(self.pairs, self.pair_tables):
            total += values[
                np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")
            ]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of a run of bins: its gain and the number of bins left of it."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree with three leaves."""
    _, cut = _split(g, h)
    parts = [(0, cut), (cut, len(g))] if cut else [(0, len(g))]
    second = [(*_split(g[a:b], h[a:b]), a, b) for a, b in parts]
    gain, inner, a, b = max(second)
    if gain > 0:
        parts = [p for p in parts if p != (a, b)] + [(a, a + inner), (a + inner, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut on each of two features: its gain and leaf values."""
    gc, hc = (np.pad(m, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for m in (g, h))
    rows, cols = np.arange(1, g.shape[0]), np.arange(1, g.shape[1])
    if not len(rows) or not len(cols):
        return 0.0, np.zeros(g.shape)
    quarters = lambda c: (
        a := c[np.ix_(rows, cols)],
        c[rows, -1][:, None] - a,
        c[-1, cols][None, :] - a,
        c[-1, -1] - c[rows, -1][:, None] - c[-1, cols][None, :] + a,
    )
    gain = sum(_gain(a, b) for a, b in zip(quarters(gc), quarters(hc)))
    r, c = np.unravel_index(gain.argmax(), gain.shape)
    out = np.zeros(g.shape)
    for part in ((slice(0, r + 1), slice(0, c + 1)), (slice(0, r + 1), slice(c + 1, None)),
                 (slice(r + 1, None), slice(0, c + 1)), (slice(r + 1, None), slice(c + 1, None))):
        out[part] = -g[part].sum() / (h[part].sum() + 1.0)
    return float(gain.max() - _gain(g.sum(), h.sum())), out


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of one-feature trees, then of two-feature trees on the strongest pairs.

    Without rows, or with rows of one label, the model is a constant.
    """
    width = len(FEATURES)
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    model = Gam(float(np.log(rate / (1 - rate))), [np.empty(0)] * width, [np.zeros(1)] * width, [np.empty(0)] * width, [], [])
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [_edges(x[:, f], BINS) for f in range(width)]
    model.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(width):
            g, h = slopes()
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(fine[f], g, size), np.bincount(fine[f], h, size))
            model.tables[f] = model.tables[f] + step
            total += step[fine[f]]
    rough = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.coarse)]
    shape = lambda i, j: (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        rows, cols = shape(i, j)
        return np.bincount(rough[i] * cols + rough[j], values, rows * cols).reshape(rows, cols)

    g, h = slopes()
    gains = [(_cross(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(width) for j in range(i + 1, width)]
    model.pairs = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros(shape(i, j)) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = RATE * _cross(grid(i, j, g), grid(i, j, h))[1]
            model.pair_tables[k] = model.pair_tables[k] + step
            total += step[rough[i], rough[j]]
    return model


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train_rows(features: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `max_rows` labelled rows outside the held-out fold, drawn by the hash of the doc_id.

    The share is set from the number of labels so that the rows drawn stay below `max_rows`
    but for a chance far under 1e-6; no task sends the driver more than it drew.
    """
    known = labels.filter(F.col(label).isNotNull() & ~held_out()).select("doc_id", F.col(label).alias("y"))
    share = min(1.0, 0.95 * max_rows / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) <= int(share * 2**32))
    rows = features.join(drawn, "doc_id").select("doc_id", "x", "y").limit(max_rows).toPandas()
    rows = rows.sort_values(["doc_id", "y"], kind="stable")
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    return x, rows["y"].to_numpy(float)


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, max_rows: int = MAX_TRAIN_ROWS
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`.

    The features come from the text alone. Rows whose crc32 of the doc_id as text is a multiple
    of five are never fitted on; of the other labelled rows at most `max_rows` are, which alone
    reach the driver. Null and empty texts have zero features and are scored like any other; a
    null doc_id counts as not held out and has no label; null labels are left out; repeated
    rows are scored alike. Without labels the score is the prior. An empty table gives an
    empty table; other columns are not read. Writes the features to the scratch folder and
    fits the model when called.
    """
    features = stored(feature_table(docs), "features")
    model = fit(*train_rows(features, labels, label, max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            scores = model.score(flat.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )
