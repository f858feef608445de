"""Line dedup: lines found in many documents are taken out of all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACE_CHARS, UPPER, ascii_lower, bind, stored, whole_text
from .ranges import split_join


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, pos, a, b): each line whose key is long enough, by key hash."""
    text = whole_text()
    each = docs.select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    )
    key = line_key(F.col("line"))
    each = each.select("doc_id", "text_hash", "pos", key.alias("key")).filter(F.char_length("key") >= min_chars)
    return each.select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), F.col("key")).alias("b")
    )


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(a, b, n_rows): line keys found in at least `min_docs` documents, counted exactly, and their lines."""
    per_doc = lines.groupBy("a", "b", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    counted = per_doc.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("n_rows"))
    return counted.filter(F.col("n") >= min_docs).select("a", "b", "n_rows")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The rows of `docs` with `kept_text`, `n_lines` (before) and `n_dropped`.

    Lines are the pieces between \\n. A line goes, in every document, when its key has at
    least `min_chars` code points and is found in at least `min_docs` documents (distinct
    doc_id; all rows without one count as one document). Null and empty texts are one empty
    line. Repeated rows are kept and treated alike; an empty table gives an empty table; an
    input column named like an output column is replaced. Keys are compared by 128-bit hash.

    Only hashes are shuffled to find the lines, a line of very many documents in parts by
    its count; texts are joined once to the positions that go. Writes the line hashes and the
    frequent keys to the scratch folder when called.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    lines = stored(lines_of(docs, min_chars), "lines")
    frequent = stored(frequent_lines(lines, min_docs), "frequent-lines")
    cuts = (
        split_join(lines, frequent, ["a", "b"], "n_rows", lines.count())
        .groupBy(F.col("doc_id").alias("cut_doc"), F.col("text_hash").alias("cut_hash"))
        .agg(F.collect_set("pos").alias("cut_lines"))
    )
    text = whole_text(docs["text"])
    joined = docs.join(
        cuts, docs["doc_id"].eqNullSafe(cuts["cut_doc"]) & (F.xxhash64(text) == cuts["cut_hash"]), "left"
    )
    cut = cuts["cut_lines"]
    pieces = F.split(text, "\n")
    rest = bind(
        pieces,
        lambda ls: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), cut), lambda i: F.get(ls, i)
            ),
            "\n",
        ),
    )
    return joined.select(
        *[docs[c] for c in docs.columns],
        F.when(cut.isNull(), text).otherwise(rest).alias("kept_text"),
        F.size(pieces).cast("long").alias("n_lines"),
        F.coalesce(F.size(cut), F.lit(0)).cast("long").alias("n_dropped"),
    )


def oracle(docs: str = "documents", min_docs: int = 10, min_chars: int = 1) -> str:
    """The same rows in SQL: the columns of `docs` as of the documents table, and the three added."""
    space = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
    return f"""
    SELECT doc_id, text, lang, source, n_chars,
           coalesce(array_to_string(list_transform(list_filter(zipped, lambda z: NOT coalesce(z.gone, false)),
                                                   lambda z: z.line), chr(10)), '') AS kept_text,
           CAST(len(zipped) AS BIGINT) AS n_lines,
           CAST(len(list_filter(zipped, lambda z: coalesce(z.gone, false))) AS BIGINT) AS n_dropped
    FROM (
      SELECT l.row_no, any_value(l.doc_id) AS doc_id, any_value(l.text) AS text, any_value(l.lang) AS lang,
             any_value(l.source) AS source, any_value(l.n_chars) AS n_chars,
             list({{'line': l.line, 'gone': f.key IS NOT NULL}} ORDER BY l.pos) AS zipped
      FROM (SELECT *, translate(trim(line, {space}), '{UPPER}', '{LOWER}') AS key
            FROM (SELECT *, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
                  FROM (SELECT *, row_number() OVER () AS row_no FROM {docs}) a) b) l
      LEFT JOIN (
        SELECT key FROM (SELECT DISTINCT doc_id, translate(trim(line, {space}), '{UPPER}', '{LOWER}') AS key
                         FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM {docs}) c) d
        WHERE length(key) >= {min_chars} GROUP BY key HAVING count(*) >= {min_docs}) f ON l.key = f.key
      GROUP BY l.row_no) g"""
