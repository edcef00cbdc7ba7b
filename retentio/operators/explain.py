"""Reason codes (G5, G8, G9) and global drivers.

Per-row top-k is a sort of a 13-element array inside each row: no
shuffle, no Python. Contributions ride along as
`array<struct<name: string, contrib: double>>`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R


def top_reasons(contribs: Column, k: int = 3) -> Column:
    """Positive contributions by value desc; when none is positive, all
    by |value| desc; ties by name. Returns the first k structs."""
    pos = F.filter(contribs, lambda x: x["contrib"] > 0)
    keyed_pos = F.transform(pos, lambda x: F.struct(
        (-x["contrib"]).alias("k"), x["name"].alias("name"), x["contrib"].alias("contrib")))
    keyed_abs = F.transform(contribs, lambda x: F.struct(
        (-F.abs(x["contrib"])).alias("k"), x["name"].alias("name"), x["contrib"].alias("contrib")))
    ranked = F.when(F.size(pos) > 0, F.sort_array(keyed_pos)).otherwise(F.sort_array(keyed_abs))
    return F.slice(ranked, 1, k)


def add_reason_codes(df: DataFrame, contribs: str = "contribs", k: int = 3,
                     drop: bool = True) -> DataFrame:
    """reason_i (display name, '' when absent) and impact_i (0.0 when absent)."""
    top = top_reasons(F.col(contribs), k)
    cols = {"_top": top}
    out = df.withColumns(cols)
    cols = {}
    for i in range(k):
        item = F.get(F.col("_top"), i)
        cols[f"reason_{i + 1}"] = F.coalesce(R.clean_feature_name(item["name"]), F.lit(""))
        cols[f"impact_{i + 1}"] = F.coalesce(item["contrib"], F.lit(0.0))
    out = out.withColumns(cols).drop("_top")
    return out.drop(contribs) if drop else out


def add_buckets_and_actions(df: DataFrame, k: int = 3, exact: bool = False) -> DataFrame:
    """G8 per reason, G9 over the reasons in order."""
    reasons = [F.col(f"reason_{i + 1}") for i in range(k) if f"reason_{i + 1}" in df.columns]
    cols = {f"bucket_{i + 1}": R.bucket_reason(F.col(f"reason_{i + 1}"))
            for i in range(len(reasons))}
    cols["recommended_action"] = R.recommend_action(reasons, exact)
    return df.withColumns(cols)


def global_drivers(df: DataFrame, contribs: str = "contribs") -> DataFrame:
    """Mean |contribution| per encoded feature over all rows (a row
    without that feature value counts 0), descending. One partial
    aggregate per task, then a merge over at most (features x values) keys."""
    n = df.select(F.count(F.lit(1))).scalar()
    return (df.select(F.explode(contribs).alias("c"))
            .groupBy(F.col("c.name").alias("feature"))
            .agg((F.sum(F.abs(F.col("c.contrib"))) / n).alias("mean_abs_contribution")))


def long_contributions(df: DataFrame, key: str = "customerID", contribs: str = "contribs") -> DataFrame:
    """(key, feature, contribution) long table of G7."""
    return (df.select(key, F.posexplode(contribs).alias("pos", "c"))
            .select(key, F.col("c.name").alias("feature"),
                    F.col("c.contrib").alias("contribution")))
