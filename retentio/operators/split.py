"""Deterministic train/test split (G1).

The reference draws a stratified 80/20 split with a seeded RNG. A seeded
RNG over a distributed table is not reproducible (row order differs per
run and per engine), so the split is a hash of (seed, key): every row
decides locally (no shuffle, no sort), the same customer always lands on
the same side, and any engine can recompute it. Because the hash ignores
the label, each class is split 80/20 in expectation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0
MAX_CLASSES = 1000


def split_fraction(key: str | Column = "customerID", seed: int = 42) -> Column:
    """A uniform value in [0, 1) from the first 32 bits of md5(seed-key)."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(F.lit(f"{seed}-"), k.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / TWO_POW_32


def is_test(key: str | Column = "customerID", test_size: float = 0.2, seed: int = 42) -> Column:
    return split_fraction(key, seed) < test_size


def with_split(df: DataFrame, key: str = "customerID", test_size: float = 0.2,
               seed: int = 42, out: str = "is_test") -> DataFrame:
    return df.withColumn(out, is_test(key, test_size, seed))


def class_allocation(counts: dict, test_size: float = 0.2) -> dict:
    """Test rows per class for an exact stratified split: n_test =
    ceil(test_size * n); each class gets floor(n_test * n_c / n), and the
    rows left over go to the classes with the largest fractional parts
    (ties: larger class, then smaller label). `counts` has one entry per
    class (bounded by the number of classes)."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    share = {c: n_test * k / n for c, k in counts.items()}
    alloc = {c: math.floor(v) for c, v in share.items()}
    left = n_test - sum(alloc.values())
    order = sorted(counts, key=lambda c: (-(share[c] - alloc[c]), -counts[c], c is None, c or 0))
    for c in order[:left]:
        alloc[c] += 1
    return alloc


def with_exact_split(df: DataFrame, label: str, key: str = "customerID", test_size: float = 0.2,
                     seed: int = 42, out: str = "is_test") -> DataFrame:
    """G1, exact-count variant: within each class, rows ordered by the same
    (seed, key) hash; the first allocation-many are the test rows. Positions
    come from range-partitioned running totals, so a class holding most rows
    is not ranked in one task. Rows without a label are a class of their own."""
    from ..plans.prefix import position_in_group
    found = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()   # one row per class
    if len(found) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values: not a class")
    counts = {r[0]: r[1] for r in found}
    alloc = class_allocation(counts, test_size)
    ranked = position_in_group(df.withColumn("_u", split_fraction(key, seed)), [label],
                               [F.col("_u").asc(), F.col(key).asc()], "_pos")
    cut = None
    for c, t in alloc.items():
        cond = F.col(label).eqNullSafe(F.lit(c))
        cut = F.when(cond, F.lit(t)) if cut is None else cut.when(cond, F.lit(t))
    return ranked.withColumn(out, F.col("_pos") < cut).drop("_u", "_pos")
