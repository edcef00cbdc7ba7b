"""Operator 3: line deduplication over three-line windows.

Every run of three consecutive lines of a document is a window, known by a
128-bit hash of its lines. The first occurrence of a window is the one with
the smallest (doc_id, row hash, line number), null ids last. All lines that
a later occurrence covers are removed; overlapping ones merge. What is
left of a document is joined by line feeds again.

Only hashes and positions are shuffled to find the windows (pre-aggregated
to one row per window and task, so a passage in a third of all documents is
a few rows per task). The texts move once, to meet the lines to remove.

Defined cases: a document of fewer than three lines has no window and stays
as it is; a null text stays null; a document may lose all lines and then
has an empty text; rows that repeat both doc_id and text count as one
document, and each of them stays with the same lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import KEY, ROW, row_key, whole_row

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """_k1, _k2, doc_id, line (0-based), h1, h2 of every window."""
    lines = _lines(F.col(f"`{text}`"))
    hashed = docs.select(
        "doc_id", *row_key(F.col("doc_id"), F.col(f"`{text}`")),
        F.transform(lines, lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit("second"), x).alias("b"))).alias("hs"))
    n = F.size("hs") - (WINDOW - 1)
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    return hashed.select("doc_id", *KEY, F.explode(F.transform(at, lambda i: F.struct(
        i.alias("line"),
        F.xxhash64(*[F.get(F.col("hs"), i + j)["a"] for j in range(WINDOW)]).alias("h1"),
        F.xxhash64(*[F.get(F.col("hs"), i + j)["b"] for j in range(WINDOW)]).alias("h2")))
        ).alias("w")).select("doc_id", *KEY, "w.line", "w.h1", "w.h2")


def _place(doc_id: str, line: str) -> Column:
    return F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"),
                    F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col(line).alias("l"))


def removed_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document that loses lines: _k1, _k2, the lines that go."""
    found = windows(docs, text)
    # written, so that the join reads a table and AQE can split a hot window
    first = materialize(
        found.groupBy("h1", "h2")
        .agg(F.min(_place("doc_id", "line")).alias("first"), F.count("*").alias("n"))
        .filter(F.col("n") > 1).drop("n"), "repeated_windows")
    later = (found.join(first, ["h1", "h2"])
             .filter(_place("doc_id", "line") != F.col("first")))
    return (later.groupBy(*KEY).agg(F.collect_set("line").alias("starts"))
            .select(*KEY, F.array_distinct(F.flatten(F.transform(
                "starts", lambda s: F.sequence(s, s + (WINDOW - 1))))).alias("_gone")))


def dedup_lines(docs: DataFrame, text: str = "text",
                removed: str | None = "lines_removed") -> DataFrame:
    """`docs` with later occurrences of repeated windows cut out of the
    text, and `removed` (the number of lines; replaced where it exists).
    Other columns stay as they are."""
    gone = materialize(removed_lines(docs, text), "line_dedup")
    t = F.col(f"`{text}`")
    keyed = docs.select(whole_row(), *row_key(F.col("doc_id"), t))
    # by shuffle at every size: the lines that go grow with the corpus
    keyed = keyed.join(gone.hint("merge"), KEY, "left")
    # the split text is a column of its own, so that it is made once a row
    split = keyed.withColumn("_lines", F.when(F.col("_gone").isNotNull(),
                                              _lines(F.col(ROW)[text])))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone")),
                       lambda i: F.get(F.col("_lines"), i))
    left = F.when(F.col("_lines").isNull(), F.col(ROW)[text]).otherwise(F.array_join(kept, "\n"))
    row = F.col(ROW).withField(f"`{text}`", left)
    if removed:
        row = row.withField(f"`{removed}`", F.when(F.col("_gone").isNull(), F.lit(0))
                            .otherwise(F.size("_gone")))
    return split.select(row.alias(ROW)).select(f"{ROW}.*")


def line_query(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("lines_removed").cast("long").alias("lines_removed"),
                      F.length("text").cast("long").alias("n_chars_left"),
                      F.md5(F.col("text").cast("binary")).alias("text_md5"))


# Rows with the same doc_id and text are one document, as in the operator.
LINE_SQL = """
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM d),
w AS (SELECT doc_id, text, i - 1 AS line,
             ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS win
      FROM (SELECT doc_id, text, ls, unnest(range(1, len(ls) - 1)) AS i FROM l)),
r AS (SELECT *, row_number() OVER (PARTITION BY win
                ORDER BY doc_id NULLS LAST, text, line) AS k FROM w),
c AS (SELECT DISTINCT doc_id, text, line + j AS line
      FROM r, (VALUES (0), (1), (2)) AS v(j) WHERE k > 1),
x AS (SELECT doc_id, text, ls[i] AS s, i - 1 AS line
      FROM (SELECT doc_id, text, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
g AS (SELECT x.doc_id, x.text, count(c.line) AS removed,
             coalesce(string_agg(CASE WHEN c.line IS NULL THEN x.s END, chr(10)
                                 ORDER BY x.line), '') AS kept
      FROM x LEFT JOIN c ON x.doc_id IS NOT DISTINCT FROM c.doc_id
                        AND x.text = c.text AND x.line = c.line
      GROUP BY x.doc_id, x.text)
SELECT o.doc_id, coalesce(g.removed, 0) AS lines_removed,
       CAST(length(g.kept) AS BIGINT) AS n_chars_left, md5(g.kept) AS text_md5
FROM documents o LEFT JOIN g ON o.doc_id IS NOT DISTINCT FROM g.doc_id AND o.text = g.text
"""
