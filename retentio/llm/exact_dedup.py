"""Operator 7: exact deduplication by content-defined chunk recipes.

A rolling hash over the bytes of a text cuts it into chunks (about 1 KB),
at places that depend on the content alone. Each chunk's content is
shuffled once: chunks are grouped by hash AND content, so every chunk gets
a verified identifier (its 64-bit hash and its rank among the different
contents of that hash; almost always 0). A document is then its ordered
list of identifiers, and documents are compared by these lists, which hold
some 2 % of the text. Equal texts have equal chunks; texts that differ,
differ in some chunk's verified content. Long documents do not move again.

Copies are pre-aggregated before each shuffle. The list meets its group
again in a join that AQE can split where a group is large.

Defined cases: a null text counts as empty (one empty list, so nulls and
empty texts are one group); the largest doc_id of a group stays; rows with
a null id never stay beside others (a group of null ids alone has a null
keep_id and keeps its rows); rows that repeat the kept doc_id and text are
all marked kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import KEY, bounded_batches, row_key

#: bytes: smallest and largest chunk, and the mean distance of cuts between
LEAST, MOST, MEAN = 512, 8192, 1024
_SPAN = 16


def _table() -> np.ndarray:
    """A 32-bit value for each byte, from a multiplicative rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


_VALUE = _table()


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the chunks of a byte string (none for an empty one)."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    # rolled[i] = sum of value[byte i - j] << j over the last 16 bytes
    rolled = _VALUE[np.frombuffer(data, dtype=np.uint8)]
    for span in (1, 2, 4, 8):
        rolled = rolled[span:] + (rolled[:-span] << np.uint32(span))
    cuts = np.flatnonzero((rolled & np.uint32((MEAN - 1) << 16)) == 0) + _SPAN
    ends, start = [], 0
    while n - start > LEAST:
        at = int(np.searchsorted(cuts, start + LEAST))
        start = min(int(cuts[at]) if at < len(cuts) else n, start + MOST, n)
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunk_column(text: Column) -> Column:
    """The chunks of a text, in order, as binary."""
    @F.pandas_udf("array<binary>")
    def chunks(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            data = (t or "").encode("utf-8")
            ends = chunk_ends(data)
            out.append([data[a:b] for a, b in zip([0, *ends], ends)])
        return pd.Series(out, dtype=object)

    return chunks(text)


def with_recipes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, _k1, _k2, text_sha256, recipe, ranks: the ordered verified
    identifiers of each row's chunks. `ranks` is null where all are 0."""
    bounded_batches(docs.sparkSession)
    t = F.col(f"`{text}`")
    key = row_key(F.col("doc_id"), t)
    cut = docs.select("doc_id", *key, F.sha2(F.coalesce(t, F.lit("")).cast("binary"), 256)
                      .alias("text_sha256"), chunk_column(t).alias("chunks"))
    recipes = materialize(
        cut.select("doc_id", *KEY, "text_sha256",
                   F.transform("chunks", lambda c: F.xxhash64(c)).alias("recipe")), "recipes")
    # every content once; a hash that has several contents is a collision
    contents = (cut.select(F.explode("chunks").alias("chunk"))
                .select(F.xxhash64("chunk").alias("h"), "chunk").distinct())
    collided = materialize(contents.groupBy("h").agg(F.count("*").alias("n"))
                           .filter(F.col("n") > 1).select("h"), "chunk_collisions")
    if not collided.limit(1).count():
        return recipes.withColumn("ranks", F.lit(None).cast("array<int>"))
    ranked = contents.join(collided, "h", "left_semi").withColumn(
        "r", F.dense_rank().over(Window.partitionBy("h").orderBy("chunk")) - 1)
    places = (cut.select(*KEY, F.posexplode("chunks").alias("at", "chunk"))
              .withColumn("h", F.xxhash64("chunk")).join(collided, "h", "left_semi").distinct())
    ranks = (places.join(ranked, ["h", "chunk"]).groupBy(*KEY)
             .agg(F.array_sort(F.collect_list(F.struct("at", "r"))).alias("found"))
             .select(*KEY, F.col("found.r").alias("ranks")))
    return recipes.join(ranks, KEY, "left")


def exact_groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    rows = with_recipes(docs, text)
    # written, so that the join reads a table and AQE can split a large group
    groups = materialize(
        rows.groupBy("recipe", "ranks").agg(F.max("doc_id").alias("keep_id"),
                                            F.count("*").alias("group_size")), "copy_groups")
    return (rows.alias("d").join(groups.alias("g"), [
        F.col("d.recipe") == F.col("g.recipe"), F.col("d.ranks").eqNullSafe(F.col("g.ranks"))])
        .select("d.doc_id", "g.keep_id", "g.group_size",
                F.col("d.doc_id").eqNullSafe(F.col("g.keep_id")).alias("kept"),
                "d.text_sha256"))


def exact_query(docs: DataFrame) -> DataFrame:
    return exact_groups(docs.select("doc_id", "text"))


EXACT_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""
