"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored, whole_text, words
from .ranges import in_order, part_starts, running

#: A table of sources up to this many rows (under 10 MB) may be broadcast; beyond, it is shuffled.
SMALL_ROWS = 100_000


def source_targets(per_source: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """(src, no_src, source_size, n_rows) with `target`: shares by weight, none above cap times its size.

    The excess of a source that stops at its cap is shared again by weight until none is
    above. That fixed point is one level L: the target is the smaller of cap * size and
    L * weight; L follows from running sums over the sources ordered by size per weight.
    Both orders are global sorts by ranges, so there may be any number of sources.
    """
    by_name = in_order(per_source, ["no_src", "src"], "sources")
    spans = part_starts(by_name)
    rank = F.col("before") + F.col("at") - F.col("first_at")
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights)).cast("int"))
    ranked = by_name.join(spans.select("part", "first_at", "before"), "part").select(
        *per_source.columns, weight.alias("weight"), (F.col("source_size") * cap).alias("most")
    )
    ranked = ranked.withColumn("ratio", F.col("source_size").cast("double") / F.col("weight"))
    by_ratio = in_order(ranked, ["ratio", "no_src", "src"], "source-ratios")
    sizes, shares = by_ratio.agg(F.sum("source_size"), F.sum("weight")).first()
    before = running(by_ratio, {"most_before": "most", "weight_before": "weight"})
    level = (F.lit(sizes) - F.col("most_before")).cast("double") / (F.lit(shares) - F.col("weight_before")).cast("double")
    leveled = before.withColumn("level", level)
    open_level = F.when(F.col("most") >= F.col("level") * F.col("weight"), F.col("level"))
    final = leveled.agg(F.max(open_level)).first()[0]  # levels fall from the first open source on
    target = F.least(F.col("most").cast("double"), F.lit(final or 0.0) * F.col("weight"))
    return by_ratio.withColumn("target", target).select("src", "no_src", "source_size", "n_rows", "target")


def random_key(doc_id: Column, seed: str) -> Column:
    """60 random bits of the document, the same in every run."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix"
) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, taken): how many words of each document the mix takes.

    Size is the number of words of a text (null: 0). Sources in code-point order, null last,
    weigh `weights`, repeating, and share the sum of all sizes; see `source_targets`. Each
    source's documents are taken in hash-random order: whole epochs first, then up to the
    exact budget (the target rounded to a word), the document at the cut in part. Ties of
    the key go by doc_id, size and text hash; repeated rows are rows of their own, an empty
    table gives an empty table, sources without a word get nothing.

    Rows are sorted by source, key and the ties above, repeated rows by their place in the
    scan, in sampled ranges; a range may begin anywhere in a source, so neither a source nor
    the rows of one key, as those without a doc_id, meet in a task. Sums per range give every
    range its offset. Writes sizes and order to the scratch folder when called.
    """
    text = whole_text()
    sized = stored(
        docs.select(
            "doc_id",
            "source",
            F.coalesce("source", F.lit("")).alias("src"),
            F.col("source").isNull().cast("int").alias("no_src"),
            F.size(words(text)).cast("long").alias("size"),
            F.xxhash64(text).alias("text_hash"),
            random_key(F.col("doc_id"), seed).alias("key"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "sizes",
    )
    per_source = stored(
        source_targets(
            sized.groupBy("src", "no_src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")),
            weights,
            cap,
        ),
        "targets",
    )
    small = per_source.count() <= SMALL_ROWS
    ordered = in_order(sized, ["no_src", "src", "key", "doc_id", "size", "text_hash", "place"], "mix-order")
    placed = running(ordered, {"before": "size"}, "no_src", "src")
    placed = placed.join(F.broadcast(per_source) if small else per_source, ["src", "no_src"])
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select(
        "doc_id", "text_hash", "source", "size", "source_size", "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
    )


def oracle(docs: str = "documents", weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, seed: str = "mix") -> str:
    """(doc_id, text, lang, source, n_chars, size, source_size, target, taken) in SQL."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
    SELECT doc_id, text, lang, source, n_chars, size, source_size, target,
           CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
    FROM (
      SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs
      FROM (
        SELECT d.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
               coalesce(sum(d.size) OVER (PARTITION BY d.src, d.no_src ORDER BY d.key, d.doc_id, d.size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT *, coalesce(source, '') AS src, CAST(source IS NULL AS INT) AS no_src,
                     CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'),
                                          lambda w: w <> '')) AS BIGINT) AS size,
                     CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
                       AS key FROM {docs}) d
        JOIN (
          SELECT src, no_src, source_size, least(CAST(most AS DOUBLE), coalesce(max(
                   CASE WHEN most >= level * weight THEN level END) OVER (), 0e0) * weight) AS target
          FROM (
            SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (
                        ORDER BY CAST(source_size AS DOUBLE) / weight, no_src, src
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (
                        ORDER BY CAST(source_size AS DOUBLE) / weight, no_src, src
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
            FROM (
              SELECT *, source_size * {cap} AS most,
                     CASE (row_number() OVER (ORDER BY no_src, src) - 1) % {len(weights)} {weight} END AS weight
              FROM (SELECT coalesce(source, '') AS src, CAST(source IS NULL AS INT) AS no_src,
                           CAST(sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'),
                                                    lambda w: w <> ''))) AS BIGINT) AS source_size
                    FROM {docs} GROUP BY 1, 2) e) f) g) t ON d.src = t.src AND d.no_src = t.no_src) h) i"""
