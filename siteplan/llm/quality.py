"""Quality rules as a short-circuit cascade, ordered by measured rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bind, stored, whole_text, words

#: Rows of the sample on which costs are measured, how often they are repeated at first and at
#: most, and how many times an empty job's time a rule must take to be measured. All this
#: decides the order of the rules, never the outcome.
SAMPLE_ROWS = 400
SAMPLE_REPEATS, MOST_REPEATS = 1, 64
OUTWEIGHS = 3


@dataclass(frozen=True)
class Rule:
    """`reject` gets the text and its words and says whether the document goes."""

    name: str
    reject: Callable[[Column, Column], Column]


def count_of(text: Column, pattern: str) -> Column:
    """Code points of the text in a character class."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def word_chars(ws: Column) -> Column:
    return F.char_length(F.array_join(ws, "")).cast("long")


def symbols(text: Column) -> Column:
    return count_of(text, r"[#*$%&|<>]+")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def odd_words(chars: Column, n: Column) -> Column:
    """No word, or words of under 2 or over 14 code points in the mean."""
    return (n == 0) | (chars < n * 2) | (chars > n * 14)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    return bind(lines_with_words(text), lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))


def _covered(starts: Column, width: int) -> Column:
    """Positions covered by windows of `width` at the sorted `starts`."""
    zero = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(width), p - acc["last"])).cast("long").alias("n")
        ),
        lambda acc: acc["n"],
    )


def repeated_words(ws: Column, width: int = 3) -> Column:
    """Words inside windows of `width` words that the text holds twice or more.

    Windows are compared by 64-bit hash within one text. Equal windows meet by one sort,
    so a long text costs n log n; a text without a repeated window is not sorted at all.
    """
    hashes = F.when(
        F.size(ws) >= width,
        bind(
            ws,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
            ),
        ),
    )

    def starts(hs: Column) -> Column:
        placed = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = bind(
            placed,
            lambda s: F.filter(
                s,
                lambda e, k: (e["h"] == F.get(s, k + 1)["h"]).eqNullSafe(True)
                | (F.when(k > 0, F.get(s, k - 1)["h"]) == e["h"]).eqNullSafe(True),
            ),
        )
        return F.array_sort(F.transform(twice, lambda e: e["i"]))

    n = bind(
        hashes,
        lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(
            _covered(starts(hs), width)
        ),
    )
    return F.coalesce(n, F.lit(0).cast("long"))


def base_rules(min_words: int = 50, repeat_percent: int = 50) -> list[Rule]:
    """Too few words, and too much repetition."""
    return [
        Rule("few_words", lambda text, ws: F.size(ws) < min_words),
        Rule("repetition", lambda text, ws: repeated_words(ws) * 100 > F.size(ws) * repeat_percent),
    ]


def text_rules() -> list[Rule]:
    """Markup and symbol noise, shouting, repeated lines, odd words."""
    return [
        Rule("symbols", lambda text, ws: symbols(text) * 10 > F.size(ws)),
        Rule("exclamation", lambda text, ws: count_of(text, r"!+") * 4 > F.size(ws)),
        Rule("shouting", lambda text, ws: count_of(text, r"\p{Lu}+") * 2 > word_chars(ws)),
        Rule("repeated_lines", lambda text, ws: repeated_lines(text) * 10 > F.size(lines_with_words(text)) * 6),
        Rule("word_length", lambda text, ws: odd_words(word_chars(ws), F.size(ws))),
        Rule("no_letters", lambda text, ws: count_of(text, r"\p{L}+") * 10 < word_chars(ws) * 6),
    ]


def order_rules(docs: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules by rejections per second on a sample, best first; those that cost alike by name.

    The sample is drawn from the whole table, and is the table itself where that is small.
    Each rule runs alone over it, repeated until its own work outweighs an empty job's time,
    which is taken off; the cost is that of one row.
    """
    share = min(1.0, 2 * SAMPLE_ROWS / max(1, docs.count()))
    drawn = docs.select(whole_text().alias("text"))
    drawn = (drawn.sample(share, seed=7) if share < 1 else drawn).limit(SAMPLE_ROWS)
    sample = stored(drawn.select("text", words(F.col("text")).alias("ws")).coalesce(1), "rule-sample")

    def run(reject: Column, repeats: int) -> tuple[float, int]:
        repeated = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        start = time.perf_counter()
        hits = repeated.select(reject.alias("hit")).agg(F.count_if("hit")).first()[0]
        return time.perf_counter() - start, hits

    nothing = F.size("ws") < 0
    run(nothing, SAMPLE_REPEATS)
    idle = min(run(nothing, SAMPLE_REPEATS)[0] for _ in range(2))
    rated = []
    for rule in rules:
        reject, repeats = rule.reject(F.col("text"), F.col("ws")), SAMPLE_REPEATS
        run(reject, 1)  # compiles it
        took, hits = run(reject, repeats)
        while took < (1 + OUTWEIGHS) * idle and repeats < MOST_REPEATS:
            repeats *= 4
            took, hits = run(reject, repeats)
        rated.append((-hits / max(took - idle, 1e-4), rule.name, rule))
    return [rule for *_, rule in sorted(rated, key=lambda r: r[:2])]


def cascade(rules: list[Rule], text: Column, ws: Column) -> Column:
    """True if some rule rejects; a later rule is computed only where all before it let pass."""
    verdict = F.lit(False)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.reject(text, ws), F.lit(False)), F.lit(True)).otherwise(verdict)
    return verdict


def with_words(docs: DataFrame) -> DataFrame:
    """`docs` with struct `_q` of the text and its words, computed once per row."""
    text = whole_text(docs["text"])
    one = docs.select("*", F.explode(F.array(F.struct(text.alias("text"), words(text).alias("ws")))).alias("_q"))
    return one


def quality_filter(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The rows of `docs` that no rule rejects, all columns as they are.

    Null and empty texts have no words and go by the rule of few words. Repeated rows are
    judged alike; an empty table stays empty. A column named `_q` is not carried. Measures
    the rules on a sample when called.
    """
    rules = order_rules(docs, base_rules() + text_rules() if rules is None else rules)
    docs = docs.drop("_q")
    judged = with_words(docs)
    return judged.filter(~cascade(rules, F.col("_q.text"), F.col("_q.ws"))).drop("_q")


def quality_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the base counts, `base_failed` and `kept`.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are computed for every row
    (null text: zeros); the cascade of the other rules runs only where the base rules pass.
    Cases as in `quality_filter`.
    """
    rules = order_rules(docs, text_rules())
    judged = with_words(docs.select("doc_id", "text"))
    text, ws = F.col("_q.text"), F.col("_q.ws")
    counted = judged.select(
        "doc_id",
        "_q",
        F.size(ws).cast("long").alias("n_words"),
        word_chars(ws).alias("word_chars"),
        symbols(text).alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        repeated_words(ws).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(~cascade(rules, text, ws))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept")
    )


def oracle(docs: str = "documents") -> str:
    """The columns of `docs`, the counts and the verdict in SQL."""
    count = lambda what: f"length(t) - length(regexp_replace(t, '{what}', '', 'g'))"
    return f"""
    SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND NOT (n_symbols * 10 > n_words OR bangs * 4 > n_words OR capitals * 2 > word_chars
                    OR n_dup_lines * 10 > n_full_lines * 6 OR NOT (word_chars / n_words BETWEEN 2 AND 14)
                    OR letters * 10 < word_chars * 6) AS kept
    FROM (
      SELECT * EXCLUDE (w, t, ls, dup),
             CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST({count('[#*$%&|<>]')} AS BIGINT) AS n_symbols, {count('!')} AS bangs,
             {count('[[:upper:]]').replace('[[:upper:]]', chr(92) + 'p{Lu}')} AS capitals,
             {count('L').replace("'L'", "'" + chr(92) + "p{L}'")} AS letters,
             len(ls) AS n_full_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(len(list_distinct(flatten(list_transform(dup, lambda p: [p, p + 1, p + 2])))) AS BIGINT) AS n_repeat_words
      FROM (
        SELECT b.*, coalesce(d.dup, []) AS dup
        FROM (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS w,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
              FROM (SELECT *, coalesce(text, '') AS t FROM {docs}) a) b
        LEFT JOIN (
          SELECT doc_id, list(p) AS dup
          FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS times
                FROM (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
                      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p
                            FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'),
                                                             lambda x: x <> '') AS w FROM {docs}) s) u) v) x
          WHERE times > 1 GROUP BY doc_id) d ON b.doc_id = d.doc_id) y) z"""
