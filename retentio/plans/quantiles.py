"""Exact quantiles of any number of rows.

Values are counted first (one partial row per task and value), the counts
get running totals over range-partitioned values (`prefix`), and each
quantile picks the two values that hold its neighbouring ranks. No task
ever holds a whole group, and the answer is the same at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running_totals


def ranked_values(df: DataFrame, value: Column, by: list[str] = (),
                  ranges: int | None = None) -> DataFrame:
    """`by`, _v, _n, cum__n, all__n: the different values that are not null,
    how often each stands, up to it, and in all."""
    by = list(by)
    counts = (df.select(*by, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
              .groupBy(*by, "_v").agg(F.count("*").alias("_n")))
    return running_totals(counts, [F.col("_v")], ["_n"], by, ranges, totals_prefix="all_")


def value_at(rank: Column) -> Column:
    """Aggregate over ranked values: the one that holds a 0-based rank."""
    here = (F.col("cum__n") > rank) & (F.col("cum__n") - F.col("_n") <= rank)
    return F.max(F.when(here, F.col("_v")))


def cuts_and_median(ranked: DataFrame, bins: int, by: list[str]) -> DataFrame:
    """`by`, cuts, median. A value is a cut when it holds the rank
    floor(i (n - 1) / bins) of some i in 1..bins - 1: at most bins - 1."""
    last, first, n = F.col("all__n") - 1, F.col("cum__n") - F.col("_n"), F.lit(bins).cast("long")
    # the least i whose rank is not before the value's first one
    i = F.greatest(F.lit(1).cast("long"), F.expr(f"(({bins}L * (cum__n - _n)) + all__n - 2) div greatest(all__n - 1, 1)"))
    rank = F.floor(last * i / n)
    cut = (i < n) & (rank >= first) & (rank < F.col("cum__n"))
    half = (F.col("all__n") - 1) / 2
    return ranked.groupBy(*by).agg(
        F.sort_array(F.collect_set(F.when(cut, F.col("_v")))).alias("cuts"),
        ((value_at(F.floor(half)) + value_at(F.ceil(half))) / 2).alias("median"))


def exact_quantiles(df: DataFrame, value: Column, probs, by: list[str] = (),
                    ranges: int | None = None) -> DataFrame:
    """`by`, q: array of the linearly interpolated quantiles of the values
    that are not null. Without `by` one row, null where there is no value."""
    by = list(by)
    ranked = ranked_values(df, value, by, ranges)
    last = F.col("all__n") - 1
    at = value_at
    made = {}
    for i, p in enumerate(probs):
        place = last * F.lit(float(p))
        made[f"_w{i}"] = F.max(place - F.floor(place))
        made[f"_l{i}"], made[f"_h{i}"] = at(F.floor(place)), at(F.ceil(place))
    picked = ranked.groupBy(*by).agg(*[c.alias(n) for n, c in made.items()])
    return picked.select(*by, F.array(*[
        (1 - F.col(f"_w{i}")) * F.col(f"_l{i}") + F.col(f"_w{i}") * F.col(f"_h{i}")
        for i in range(len(probs))]).alias("q"))
