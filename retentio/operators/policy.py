"""Live retention policy, segments, capacity routing, queues and views
(H11-H16, E1-E8, C1-C5, D6, D7, D9-D13).

Capacity routing ("top N among eligible") never ranks the whole table in
one task: `orderBy(...).limit(N)` plans as a per-task top-N plus a merge
of N rows per task, and the N ids are joined back as a flag (broadcast
only when N is under the broadcast limit, salted shuffle otherwise).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LiveParams
from ..functions import rules as R
from ..plans.lookup import lookup_join
from ..plans.prefix import position_in_group
from . import value as V

# ---- C1 / C5 -------------------------------------------------------------------

def merge_suffixed(left: DataFrame, right: DataFrame, key: str = "customerID",
                   suffix: str = "_v2", how: str = "left") -> DataFrame:
    """Left equi-join; right columns that collide get `suffix`.
    Spark resolves names case-insensitively, so `churn_prob` collides with
    `Churn_Prob` here (pandas keeps both)."""
    have = {c.lower() for c in left.columns}
    ren = {c: c + suffix for c in right.columns if c != key and c.lower() in have}
    return left.join(right.withColumnsRenamed(ren), key, how)


def key_profile(df: DataFrame, key: str = "customerID") -> DataFrame:
    """Rows, distinct keys, keys occurring more than once (a duplicate
    key would multiply C1 rows and over-mark C3)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.count_if(F.col("n") > 1).alias("duplicate_keys"))


# ---- E6 / C3 -----------------------------------------------------------------------

def top_n_flag(df: DataFrame, eligible: Column, score: Column, n: int, flag: str,
               key: str = "customerID") -> DataFrame:
    """E6 + C3: flag rows whose key is among the top `n` eligible rows by
    score (ties by key). Rows sharing a flagged key are all flagged."""
    if n <= 0:
        return df.withColumn(flag, F.lit(False))
    top = (df.filter(eligible).select(F.col(key), score.alias("_s"))
           .orderBy(F.col("_s").desc_nulls_last(), F.col(key).asc()).limit(n)
           .select(key).distinct().withColumn(flag, F.lit(True)))
    out = lookup_join(df, top, key, "left", small_rows=n)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# ---- H11 / H12 -------------------------------------------------------------------

def v1_segments(df: DataFrame, threshold, prob: str = "Churn_Prob") -> DataFrame:
    """Critical (p >= .85) / Target (p >= thr) / Safe with actions."""
    seg, act = R.v1_segment(F.col(prob), threshold)
    return df.withColumns({"Segment": seg, "Action": act})


def capacity_segments(df: DataFrame, threshold, capacity: int, prob: str = "Churn_Prob",
                      key: str = "customerID") -> DataFrame:
    """Safe; p >= thr -> Target; the top `capacity` of those -> Critical."""
    p = F.col(prob)
    out = top_n_flag(df, p >= threshold, p, capacity, "_crit", key)
    seg = (F.when(F.col("_crit"), R.SEGMENT_CRITICAL).when(p >= threshold, R.SEGMENT_TARGET)
           .otherwise(R.SEGMENT_SAFE))
    act = (F.when(F.col("_crit"), R.ACTION_CALL).when(p >= threshold, R.ACTION_DISCOUNT)
           .otherwise(R.ACTION_NONE))
    return out.withColumns({"Segment": seg, "Action": act}).drop("_crit")


# ---- H13 / H3 / H14 ------------------------------------------------------------------

def live_policy(merged: DataFrame, params: LiveParams = LiveParams()) -> DataFrame:
    """Value base (fixed LTV or CLV), expected loss, offer cost, flag, ROI."""
    cost = F.lit(float(params.cost_fp))
    if "risk_30d" not in merged.columns:
        return merged.withColumns({
            "value_basis_live": F.lit("n/a"), "value_base_live": F.lit(None).cast("double"),
            "expected_loss_30d_live": F.lit(None).cast("double"), "offer_cost_live": cost,
            "should_intervene_live": F.lit(0), "roi_proxy_live": F.lit(None).cast("double")})
    risk30 = F.coalesce(F.col("risk_30d"), F.lit(0.0))
    if params.use_fixed_ltv:
        basis, base = F.lit("Fixed LTV"), F.lit(float(params.cost_fn))
    else:
        basis = F.lit("CLV proxy")
        base = F.coalesce(F.col("clv"), F.lit(0.0)) if "clv" in merged.columns else F.lit(0.0)
    loss = risk30 * base
    return merged.withColumns({
        "value_basis_live": basis, "value_base_live": base, "expected_loss_30d_live": loss,
        "offer_cost_live": cost,
        "should_intervene_live": (loss > cost).cast("int"),
        "roi_proxy_live": loss - cost})


def live_value_segments(df: DataFrame) -> DataFrame:
    """H3 on the merged view, kept beside the policy segment."""
    if "clv" not in df.columns:
        return df.withColumn("value_segment_live", F.lit("unknown"))
    return V.value_segment_quantile(df, "clv", "value_segment_live")


def live_filters(df: DataFrame, params: LiveParams = LiveParams(),
                 seg_col: str = "value_segment_live") -> DataFrame:
    """B20 + B21 with the live flag (applied before routing, as upstream)."""
    out = df
    if params.min_value_segment != "all":
        keep = ["mid", "high"] if params.min_value_segment == "mid" else ["high"]
        out = out.filter(F.col(seg_col).isin(keep))
    if params.only_intervene and "should_intervene_live" in out.columns:
        out = out.filter(F.col("should_intervene_live") == 1)
    return out


def live_routing(df: DataFrame, params: LiveParams = LiveParams(), key: str = "customerID") -> DataFrame:
    """Routing score = chosen risk window (NULL -> 0); Safe / Target
    (live flag) / Critical (top `calls_per_week` flagged by score)."""
    if params.risk_window in df.columns:
        score = F.coalesce(F.col(params.risk_window), F.lit(0.0))
    elif "risk_30d" in df.columns:
        score = F.coalesce(F.col("risk_30d"), F.lit(0.0))
    else:
        score = F.lit(0.0)
    out = df.withColumn("routing_score_live", score)
    eligible = F.col("should_intervene_live") == 1
    out = top_n_flag(out, eligible, F.col("routing_score_live"), params.calls_per_week, "_crit", key)
    tier = (F.when(F.col("_crit"), R.SEGMENT_CRITICAL).when(eligible, R.SEGMENT_TARGET)
            .otherwise(R.SEGMENT_SAFE))
    return out.withColumn("routing_tier_live", tier).drop("_crit")


def live_view(scored: DataFrame, decisions: DataFrame, threshold, params: LiveParams = LiveParams(),
              key: str = "customerID") -> DataFrame:
    """The merged dashboard's working table: v2 capacity segments on the
    scored hold-out, left join of the decision table, live policy, quantile
    value segments, sidebar filters, routing."""
    seg = capacity_segments(scored, threshold, params.calls_per_week, "Churn_Prob", key)
    merged = merge_suffixed(seg, decisions, key)
    merged = live_policy(merged, params)
    merged = live_value_segments(merged)
    return live_routing(live_filters(merged, params), params, key)


# ---- D6 / D7 / D9-D13 -------------------------------------------------------------

def portfolio_kpis(df: DataFrame) -> DataFrame:
    """Customers, expected loss (30d), offer cost, ROI proxy."""
    return df.agg(F.count(F.lit(1)).alias("customers"),
                  F.coalesce(F.sum("expected_loss_30d"), F.lit(0.0)).alias("expected_loss_30d"),
                  F.coalesce(F.sum("offer_cost"), F.lit(0.0)).alias("offer_cost"),
                  F.coalesce(F.sum("roi_proxy"), F.lit(0.0)).alias("roi_proxy"))


def live_kpis(df: DataFrame) -> DataFrame:
    """Targets, live loss / cost / ROI sums, queue sizes."""
    return df.agg(
        F.count_if(F.col("should_intervene_live") == 1).alias("target_customers"),
        F.coalesce(F.sum("expected_loss_30d_live"), F.lit(0.0)).alias("expected_loss_30d"),
        F.coalesce(F.sum("offer_cost_live"), F.lit(0.0)).alias("offer_cost"),
        F.coalesce(F.sum("roi_proxy_live"), F.lit(0.0)).alias("roi_proxy"),
        F.count_if(F.col("routing_tier_live") == R.SEGMENT_CRITICAL).alias("critical_queue"),
        F.count_if(F.col("routing_tier_live") == R.SEGMENT_TARGET).alias("target_campaigns"))


def value_counts(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Frequency of each value."""
    return df.groupBy(F.col(col).alias(name or col)).agg(F.count(F.lit(1)).alias("count"))


def segment_profile(df: DataFrame, threshold, prob: str = "Churn_Prob") -> DataFrame:
    """Mean tenure and MonthlyCharges, High Risk (p >= thr) vs Safe."""
    grp = F.when(F.col(prob) >= threshold, "High Risk").otherwise("Safe")
    return df.groupBy(grp.alias("Group")).agg(F.avg("tenure").alias("tenure"),
                                                 F.avg("MonthlyCharges").alias("MonthlyCharges"))


def stacked_counts(df: DataFrame, cols, name: str) -> DataFrame:
    """Frequency over several columns stacked (UNION ALL); empty
    and NULL values drop (an empty text cell reads back as missing)."""
    vals = F.explode(F.array(*[F.nullif(F.col(c), F.lit("")) for c in cols if c in df.columns]))
    return (df.select(vals.alias(name)).filter(F.col(name).isNotNull())
            .groupBy(name).agg(F.count(F.lit(1)).alias("count")))


def top_reasons(df: DataFrame, k: int = 15) -> DataFrame:
    """The k most frequent reasons over reason_1..3 (ties by reason)."""
    return (stacked_counts(df, ["reason_1", "reason_2", "reason_3"], "reason")
            .orderBy(F.col("count").desc(), F.col("reason").asc()).limit(k))


# ---- E1-E8 / H15 / H16 -------------------------------------------------------------------

#: tasks whose first rows are merged by one task, before the last merge
MERGED_TASKS = 64


def top_rows(df: DataFrame, order: list[Column], n: int, position: str | None = None) -> DataFrame:
    """First n rows in an order. Every task keeps its first n;
    with more than MERGED_TASKS shuffle partitions these are merged per group
    of tasks first, so the last task reads n rows per group instead of per
    task. `position`, when given, adds the 1-based place as a column."""
    if int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) > MERGED_TASKS:
        grouped = df.withColumn("_task", F.spark_partition_id()).withColumn(
            "_group", F.floor(F.col("_task") / MERGED_TASKS))
        place = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
        df = grouped.withColumn("_place", place).filter(F.col("_place") <= n).drop(
            "_task", "_group", "_place")
    out = df.orderBy(*order).limit(n)
    # a window over n rows
    return out.withColumn(position, F.row_number().over(Window.orderBy(*order))) if position else out


def with_position(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """The 1-based place of every row in a total order, as a column:
    the order survives a write. Range-partitioned, no single task."""
    return position_in_group(df, [], order, out).withColumn(out, F.col(out) + 1)


def queue(df: DataFrame, tier: str, n: int = 200, key: str = "customerID",
          position: str | None = None) -> DataFrame:
    """One routing queue, by routing score desc."""
    return top_rows(df.filter(F.col("routing_tier_live") == tier),
                    [F.col("routing_score_live").desc(), F.col(key).asc()], n, position)


def action_list(df: DataFrame, n: int = 500, key: str = "customerID",
                position: str | None = None) -> DataFrame:
    """By live ROI, else stored ROI, else probability; first n."""
    for c in ("roi_proxy_live", "roi_proxy", "Churn_Prob"):
        if c in df.columns:
            return top_rows(df, [F.col(c).desc_nulls_last(), F.col(key).asc()], n, position)
    raise ValueError("no sortable score column")


def sorted_positions(df: DataFrame, x: str, group: str = "Segment", key: str = "customerID",
                     out: str = "position") -> DataFrame:
    """0-based position by x within each group (x NULLs last)."""
    return position_in_group(df, [group], [F.col(x).asc_nulls_last(), F.col(key).asc()], out)


# ---- fixed values: column names of the case file and the action list ------------
CASE_FILE_COLUMNS = (
    "customerID", "Churn_Prob", "churn_prob_v2", "risk_30d", "risk_60d", "risk_90d", "clv",
    "value_segment", "value_segment_live", "value_basis_live", "value_base_live",
    "expected_loss_30d_live", "offer_cost_live",
    "roi_proxy_live", "should_intervene_live", "routing_tier_live",
    "reason_1", "impact_1", "bucket_1", "reason_2", "impact_2", "bucket_2",
    "reason_3", "impact_3", "bucket_3", "recommended_action", "intervention_type")
ACTION_LIST_COLUMNS = (
    "position", "customerID", "Churn_Prob", "churn_prob_v2", "risk_30d", "risk_60d", "risk_90d",
    "Segment", "tenure", "MonthlyCharges", "Contract", "PaymentMethod", "clv", "value_segment",
    "value_segment_live", "value_basis_live", "value_base_live", "expected_loss_30d_live",
    "offer_cost_live", "should_intervene_live", "roi_proxy_live", "routing_score_live",
    "routing_tier_live", "reason_1", "recommended_action", "intervention_type")
# ---------------------------------------------------------------------------


def case_file(df: DataFrame, customer, key: str = "customerID") -> DataFrame:
    """B23 + H15: one customer's case file (first match). Keys are normalised
    where they enter, so here the argument is: the plain equality reaches the
    scan, which reads one bucket and skips by the key's Bloom filter."""
    one = df.filter(F.col(key) == str(customer).strip()).limit(1)
    return one.select(*[c for c in CASE_FILE_COLUMNS if c in df.columns])
