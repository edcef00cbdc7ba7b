"""Operator 4: SimHash near-deduplication.

Fingerprints are made in one narrow stage. Equal fingerprints are one node,
so copies, however many, cost one row from then on. Two fingerprints at
`bits` or fewer differing bits agree in at least `blocks - bits` of `blocks`
blocks (pigeonhole): each is listed under every choice of that many blocks
(20 keys of 32 or more bits by default), fingerprints that share a key are
joined, and the Hamming distance is verified. A pair is kept under the
first key it shares, so it is emitted once. Keys held by one fingerprint
alone are dropped before the join. A key held by more than CHUNK of them is
dealt out as pairs of chunks, so every join group holds 2 * CHUNK rows at
most and the comparisons spread evenly; no pair is lost.

Links make components (smallest label, iterated over written tables).

Defined cases: a null text counts as empty; a text without words has the
fingerprint zero and links like any other; rows that repeat a doc_id share
its component if their texts do; null ids take the component of their
fingerprint and never name one (a component of null ids alone has a null
id, and a doc_id on unlinked texts names several: `label`, the smallest
fingerprint, tells components apart); an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import KEY, ROW, bounded_batches, row_key, whole_row
from .components import connected_components

SHINGLE, BITS, BLOCKS = 3, 3, 6
SEED = 42
#: fingerprints of one key that are compared in one join group
CHUNK = 512
_PART = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles (0 without words)."""
    # ASCII lower case and ASCII white space: what bytes methods do
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:n].tolist()
    end = end[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(start, end)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _PART):
        part = h[at:at + _PART].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return simhash(text)


def block_masks(blocks: int = BLOCKS, bits: int = BITS) -> list[int]:
    """Masks (signed) of every choice of `blocks - bits` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(single, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """a < b: every pair of different fingerprints (column `fp`, distinct)
    at `bits` or fewer differing bits."""
    masks = block_masks(blocks, bits)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    shared = materialize(keyed.groupBy("t", "key").agg(F.count("*").alias("n"))
                         .filter(F.col("n") > 1), "simhash_shared")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    member = materialize(
        keyed.join(shared, ["t", "key"])
        .withColumn("c", chunks)
        .withColumn("g", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")), "simhash_keys")
    dealt = (member.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
             .select("t", "key", "fp", "g", F.least("g", "o").alias("lo"),
                     F.greatest("g", "o").alias("hi")))
    left, right = dealt.alias("l"), dealt.alias("r")
    differ = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(t))
                         for t, m in enumerate(masks)])
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("t", "key", "lo", "hi")]
    return (left.join(right, [*same, F.col("l.fp") < F.col("r.fp"),
                              (F.col("l.lo") == F.col("l.hi")) | (F.col("l.g") != F.col("r.g")),
                              F.bit_count(differ) <= bits, first == F.col("l.t")])
            .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS,
                    blocks: int = BLOCKS, text: str = "text") -> DataFrame:
    """doc_id, _k1, _k2, fp, label, component_id, n_links: one row per row
    of `docs`; label (smallest fingerprint) is unique to its component,
    n_links counts the different fingerprints linked to its own."""
    bounded_batches(docs.sparkSession)
    prints = materialize(
        docs.select("doc_id", *row_key(F.col("doc_id"), F.col(f"`{text}`")),
                    fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp")), "simhash")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_nodes")
    pairs = materialize(links(nodes.select("fp"), bits, blocks), "simhash_links")
    degree = (pairs.select(F.explode(F.array("a", "b")).alias("fp"))
              .groupBy("fp").agg(F.count("*").alias("n_links")))
    label = connected_components(pairs).withColumnRenamed("node", "fp")
    joined = nodes.join(label, "fp", "inner").join(degree, "fp")
    least = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    linked = joined.join(least, "label").select("fp", "label", "component_id", "n_links")
    # written, so that the join reads a table and AQE can split a hot print
    known = materialize(nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"),
        F.when(F.col("label").isNull(), F.col("first")).otherwise(F.col("component_id"))
        .alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "simhash_components")
    return prints.join(known, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS,
             blocks: int = BLOCKS, text: str = "text") -> DataFrame:
    """One row of each component of `docs`: the one with the smallest
    doc_id (null ids last, ties by row hash; of equal rows any one)."""
    found = near_duplicates(docs, shingle, bits, blocks, text)
    kept = found.groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("n"), "doc_id", *KEY)).alias("m")).select("m._k1", "m._k2")
    # equal rows share the key: one of them stays
    once = Window.partitionBy(*KEY).orderBy(*KEY)
    return (docs.select(whole_row(), *row_key(F.col("doc_id"), F.col(f"`{text}`")))
            .join(kept, KEY, "left_semi")
            .withColumn("_n", F.row_number().over(once)).filter(F.col("_n") == 1)
            .select(f"{ROW}.*"))


def simhash_query(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs.select("doc_id", "text"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      "component_id", "n_links")
