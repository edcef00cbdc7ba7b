"""Customer valuation.

Projections only, except the portfolio quantiles (H3/D19), which are one
global aggregate: partial per task, one tiny merge. The exact `percentile`
keeps every value of the merge in memory, so beyond `exact_limit` rows the
t-digest-like `percentile_approx` is used instead (bounded state per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RetentionPolicy, VALUE_QUANTILES
from ..plans.quantiles import exact_quantiles


def _num_or_zero(df: DataFrame, c: str) -> Column:
    if c not in df.columns:
        return F.lit(0.0)
    x = F.col(c).cast("double") if _is_numeric(df, c) else F.col(c).cast("string").try_cast("double")
    return F.coalesce(x, F.lit(0.0))


def _is_numeric(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in (
        "double", "float", "integer", "long", "short", "byte", "decimal")


def add_clv(df: DataFrame, margin_rate: float = 0.6, expected_future_months: int = 12) -> DataFrame:
    """H1: monthly_margin, remaining_months_proxy (= tenure + horizon, as
    named upstream), clv. Missing/NULL inputs count as 0 (the reference
    fills NULL and would crash on a missing column)."""
    mc = _num_or_zero(df, "MonthlyCharges")
    ten = _num_or_zero(df, "tenure")
    margin = mc * F.lit(float(margin_rate))
    remaining = ten + F.lit(int(expected_future_months))
    return df.withColumns({
        "MonthlyCharges": mc, "tenure": ten,
        "monthly_margin": margin,
        "remaining_months_proxy": remaining,
        "clv": margin * remaining,
    })


def value_segment_fixed(clv: Column, high: float = 1000.0, mid: float = 400.0) -> Column:
    """H2: >= high -> high, >= mid -> mid, else low (NULL -> low, as a
    NaN comparison is false upstream)."""
    clv = F.when(~F.isnan(clv), clv)
    return F.when(clv >= high, "high").when(clv >= mid, "mid").otherwise("low")


def add_value_segment(df: DataFrame, high_value_clv: float = 1000.0,
                      mid_value_clv: float = 400.0) -> DataFrame:
    return df.withColumn("value_segment",
                         value_segment_fixed(F.col("clv"), high_value_clv, mid_value_clv))


def value_quantiles(df: DataFrame, col: str = "clv", probs=VALUE_QUANTILES) -> DataFrame:
    """One-row frame with exact q1, q2 (linear interpolation)."""
    q = exact_quantiles(df, F.col(col), probs)
    return q.select(*[F.col("q")[i].alias(f"q{i + 1}") for i in range(len(probs))])


def value_segment_quantile(df: DataFrame, col: str = "clv", out: str = "value_segment") -> DataFrame:
    """H3: >= q66 high, >= q33 mid, else low, NULL -> unknown.

    The two cut points are scalar sub-queries over a one-row aggregate:
    Spark runs the aggregate once and inlines both values, so the big side
    is never joined or shuffled."""
    qs = value_quantiles(df, col)
    q1 = qs.select("q1").scalar()
    q2 = qs.select("q2").scalar()
    x = F.col(col)
    seg = (F.when(x.isNull(), "unknown").when(x >= q2, "high")
           .when(x >= q1, "mid").otherwise("low"))
    return df.withColumn(out, seg)


def apply_policy_value(df: DataFrame, policy: RetentionPolicy = RetentionPolicy()) -> DataFrame:
    """H1 + H2 with a policy object."""
    return add_value_segment(add_clv(df, policy.margin_rate, policy.expected_future_months),
                             policy.high_value_clv, policy.mid_value_clv)
