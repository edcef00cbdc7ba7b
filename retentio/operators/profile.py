"""Exploratory aggregates.

Every per-column profile is ONE job: columns are unpivoted into
(feature, value) pairs and aggregated together, instead of one job per
column. Aggregates are partial per task, so a hot value costs one partial
row per task. Quantiles are exact at every size (`plans/quantiles.py`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..plans.quantiles import exact_quantiles
from .features import split_by_dtype

IGNORE_V1 = ("customerID", "Churn", "Churn_Target")
IGNORE_V2 = ("customerID", "Churn")
DIST_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


def _long(df: DataFrame, cols, keep, value_type: str = "string") -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(value_type).alias("value"))
                      for c in cols])
    return df.select(*keep, F.inline(pairs))


def churn_rate_by_category(df: DataFrame, cols=None, target: str = "Churn_Target",
                           ignore=IGNORE_V1) -> DataFrame:
    """Churn rate and size per (feature, value) over every categorical
    column at once; NULL values drop (as a group-by on NaN does)."""
    if cols is None:
        cols = [c for c in split_by_dtype(df)[1] if c not in ignore]
    long = _long(df, cols, [target]).filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(
        F.avg(F.col(target).cast("double")).alias("churn_rate"),
        F.count(F.lit(1)).alias("customers"))


def top_categories(df: DataFrame, n_cols: int = 8, top: int = 12, target: str = "Churn_Target") -> DataFrame:
    """First `n_cols` text columns, top `top` values by churn rate
    (ties by value). The window runs over the aggregated table only."""
    cols = [c for c in split_by_dtype(df)[1] if c not in IGNORE_V2][:n_cols]
    rates = churn_rate_by_category(df, cols, target)
    w = Window.partitionBy("feature").orderBy(F.col("churn_rate").desc(), F.col("value"))
    return (rates.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .filter(F.col("rank") <= top))


def churn_by_tenure_bucket(df: DataFrame, bins=C.TENURE_BINS_V2, target: str = "Churn_Target") -> DataFrame:
    """D3: churn rate per tenure bucket with its ordinal."""
    return (df.filter(F.col("Tenure_Bucket").isNotNull())
            .groupBy("Tenure_Bucket")
            .agg(F.avg(F.col(target).cast("double")).alias("churn_rate"),
                 F.count(F.lit(1)).alias("customers"))
            .withColumn("ordinal", C.bin_ordinal("Tenure_Bucket", bins)))


def correlation_matrix(df: DataFrame, cols=None, exclude=("days_to_churn", "y_30d", "y_60d", "y_90d")) -> DataFrame:
    """Pearson correlation for every ordered pair of numeric columns,
    pairwise-complete (a row with a NULL on either side is skipped), in a
    single aggregate."""
    if cols is None:
        cols = [c for c in split_by_dtype(df)[0] if c not in exclude]
    num = [F.col(c).cast("double") for c in cols]
    aggs, names = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(F.corr(num[i], num[j]).alias(f"c{i}_{j}"))
            names.append((i, j))
    one = df.agg(*aggs)
    pairs = []
    for i, j in names:
        pairs.append(F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"),
                              F.col(f"c{i}_{j}").alias("corr")))
        if i != j:
            pairs.append(F.struct(F.lit(cols[j]).alias("feature_a"), F.lit(cols[i]).alias("feature_b"),
                                  F.col(f"c{i}_{j}").alias("corr")))
    return one.select(F.inline(F.array(*pairs)))


def distribution_by_label(df: DataFrame, cols=("tenure", "MonthlyCharges", "TotalCharges",
                                               "Avg_Historical_Charge"),
                          target: str = "Churn_Target") -> DataFrame:
    """Per churn label and feature: count, mean, min, quantiles, max."""
    cols = [c for c in cols if c in df.columns]
    long = (_long(df, cols, [C.churn_label_text(target).alias("Churn_Label")], "double")
            .filter(F.col("value").isNotNull()))
    q = exact_quantiles(long, F.col("value"), DIST_PROBS, ["Churn_Label", "feature"])
    out = long.groupBy("Churn_Label", "feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    # two tables of one row per label and feature
    return out.join(q, ["Churn_Label", "feature"]).select(
        "Churn_Label", "feature", "n", "mean", "min", "max",
        *[F.col("q")[i].alias(f"p{int(p * 100):02d}") for i, p in enumerate(DIST_PROBS)])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """D15."""
    return df.select(col).distinct()


def medians(df: DataFrame, cols=None) -> DataFrame:
    """Per numeric column median (the imputation statistic), long."""
    if cols is None:
        cols = split_by_dtype(df)[0]
    q = exact_quantiles(_long(df, cols, [], "double"), F.col("value"), [0.5], ["feature"])
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(q, "feature", "left").select("feature", F.col("q")[0].alias("median"))
