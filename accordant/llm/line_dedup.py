"""Line deduplication over overlapping windows of three lines, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (``doc``, ``row``, ``pos``, ``window``) for every three consecutive lines.

    ``window`` is the SHA-256 digest of the lines; texts of fewer than three lines have none. ``row`` tells
    rows of one id apart by their texts.
    """
    lines = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("row"), F.split(text_col, "\n").alias("lines"))
    numbered = lines.filter(F.size("lines") >= WINDOW).select("doc", "row", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("lines") - (WINDOW - 1)),
        lambda i: F.unhex(F.sha2(F.array_join(F.slice("lines", i, F.lit(WINDOW)), "\n"), 256)))).alias("pos", "window"))
    return numbered.filter(F.col("doc").isNotNull())


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positions of lines covered by a later occurrence of a window: (``doc``, ``row``, ``covered`` sorted array).

    The first occurrence in the order of (document, row, position) stays. Counting is pre-aggregated before
    its shuffle, and only windows seen more than once are joined back, a row for each later occurrence.
    """
    windows = line_windows(docs, id_col, text_col)
    first = (windows.groupBy("window").agg(F.min(F.struct("doc", "row", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("window", "first"))
    later = windows.join(first, "window").filter(F.struct("doc", "row", "pos") != F.col("first"))
    return later.groupBy("doc", "row").agg(F.collect_set("pos").alias("starts")).select("doc", "row", F.array_sort(F.array_distinct(
        F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (WINDOW - 1)))))).alias("covered"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` replaced, plus ``n_lines`` and ``n_removed`` (long).

    Every line covered by a later occurrence of a three-line window goes; the rest is joined again by
    line breaks. Null texts stay null with 0 lines, an empty text has one (empty) line, a text of which
    all lines go becomes empty. Rows without an id take no part and stay as they are. Rows that repeat an
    id with the same text count as one place, so each keeps or loses the same lines.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    covered = repeated_lines(docs, id_col, text_col)
    joined = docs.select(*kept).join(covered.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.col("covered").alias("_covered")),
                                     (F.col(id_col).cast("long") == F.col("_doc")) & (F.xxhash64(text_col) == F.col("_row")), "left")
    lines = F.split(F.col(text_col), "\n")
    left = F.array_except(F.transform(lines, lambda _, i: i), F.col("_covered"))  # hashed, in order
    text = F.when(F.col("_covered").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        *[(text.alias(c) if c == text_col else F.col(c)) for c in kept],
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("_covered").isNull(), 0).otherwise(F.size(lines) - F.size(left)).cast("long").alias("n_removed"))


#: Same rows from the lines themselves.
ORACLE_SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, p, lines[p:p+2] AS win FROM l, unnest(generate_series(1, len(lines) - 2)) AS g(p)),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS k FROM w),
c AS (SELECT doc_id, list_distinct(list_concat(list(p), list(p + 1), list(p + 2))) AS covered FROM r WHERE k > 1 GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN c.doc_id IS NULL THEN d.text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(l.lines) + 1), lambda i: NOT list_contains(c.covered, i)), lambda i: l.lines[i]), chr(10)), '') END AS text,
       CAST(coalesce(len(l.lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(c.covered), 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
"""
