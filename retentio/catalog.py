"""Named queries over the driver tables, one per operator of the inventory.

Each entry is `(spark, sf_dir) -> DataFrame`. Every query reads the
driver's `customer` and `orders` tables (through the derived subscriber
frame) so its work grows with them. Doubles are rounded to 6 places at the
edge only, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import OFFER_COSTS, LiveParams
from .functions import rules as R
from .operators import evaluate as Ev
from .operators import encoding as EN
from .operators import explain as X
from .operators import features as B
from .operators import models as ML
from .operators import policy as P
from .operators import profile as D
from .operators import trees as TR
from .operators import value as H
from .plans import jobs as J
from .plans import tables as T_
from .sources import fixture
from .sources import tables as SRC

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (edge presentation for cross-engine checks)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


# ---- shared inputs -----------------------------------------------------------

def subscribers(spark, sf):
    return fixture.subscribers(spark, sf)


def engineered(spark, sf, profile="v2"):
    return B.engineered(subscribers(spark, sf), profile)


# ---- scans and cleaning ------------------------------------------------------

@query("fixture_subscribers")
def q_fixture(spark, sf):
    """Subscriber frame derived from customer + orders (FIXTURES.md §2)."""
    return rounded(subscribers(spark, sf))


@query("engineered_v2")
def q_engineered_v2(spark, sf):
    """B29 (B1, B2, B4-B8, B10, B11, B13)."""
    return rounded(engineered(spark, sf, "v2"))


@query("engineered_v1")
def q_engineered_v1(spark, sf):
    """B3, B9, B12, B14 (v1 profile)."""
    return rounded(engineered(spark, sf, "v1"))


@query("contract_tenure_value")
def q_contract_tenure_value(spark, sf):
    """Minimum slice: churn rate and total CLV by Contract x Tenure_Bucket."""
    v = H.apply_policy_value(engineered(spark, sf))
    return rounded(v.groupBy("Contract", "Tenure_Bucket").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("Churn_Target").alias("churn_rate"),
        F.sum("clv").alias("total_clv")))


# ---- split, labels, model, scores, explanations --------------------------------


_MODELS: dict = {}


def labeled(spark, sf):
    return J.labeled(subscribers(spark, sf))


def _session_key(spark):
    """Cache key of a live session: its application and the session object."""
    return (spark.sparkContext.applicationId, id(spark))


def model(spark, sf):
    return _cached("scorecard", spark, sf, lambda: J.fit_models(labeled(spark, sf)))


def _cached(kind, spark, sf, build):
    """Per-session memo of fitted models and written tables (so the many
    queries over one hold-out fit and score once per session)."""
    key = (kind, _session_key(spark), sf)
    if key not in _MODELS:
        _MODELS[key] = build()
    return _MODELS[key]


def scored(spark, sf):
    """Scored hold-out, written once per session as a table boundary."""
    return _cached("scored", spark, sf, lambda: T_.bucketed(
        J.scored(labeled(spark, sf), model(spark, sf)), "scored"))


@query("split_flags")
def q_split(spark, sf):
    """G1: id-hash split flag and class balance per side."""
    lab = labeled(spark, sf)
    return lab.groupBy("is_test", "Churn_Target").agg(F.count(F.lit(1)).alias("customers"))


@query("window_labels")
def q_window_labels(spark, sf):
    """G11 + G12: days to churn and per-horizon labels."""
    lab = labeled(spark, sf)
    return rounded(lab.select("customerID", "Churn_Target", "days_to_churn",
                              "y_30d", "y_60d", "y_90d"))


@query("scorecard_model")
def q_scorecard_model(spark, sf):
    """G7a fit: per (feature, value) counts, weight of evidence, contribution."""
    t = model(spark, sf).table
    return rounded(t.select("feature", "value", F.col("n").cast("double").alias("n"),
                            *[F.col(f"pos_{l}").cast("double").alias(f"pos_{k}")
                              for l, k in (("Churn_Target", "c"), ("y_30d", "30"),
                                           ("y_60d", "60"), ("y_90d", "90"))],
                            *[F.col(f"c_{l}").alias(f"c_{k}")
                              for l, k in (("Churn_Target", "c"), ("y_30d", "30"),
                                           ("y_60d", "60"), ("y_90d", "90"))]))


@query("scores_test")
def q_scores(spark, sf):
    """G4 batch scoring with G7a: churn and horizon probabilities, hold-out rows."""
    return rounded(scored(spark, sf).select("customerID", "churn_prob", "risk_30d",
                                            "risk_60d", "risk_90d"))


@query("contributions")
def q_contributions(spark, sf):
    """G7 long table: (customer, encoded feature, contribution)."""
    return rounded(X.long_contributions(scored(spark, sf)))


@query("reason_codes")
def q_reason_codes(spark, sf):
    """G5 + G6 + G8 + G9."""
    return rounded(J.reason_code_table(scored(spark, sf)))


@query("global_drivers")
def q_global_drivers(spark, sf):
    """Mean |contribution| per encoded feature."""
    return rounded(X.global_drivers(scored(spark, sf)))


@query("top_drivers")
def q_top_drivers(spark, sf):
    """D14 + E5: the 20 strongest global drivers (ties by feature)."""
    g = X.global_drivers(scored(spark, sf))
    return rounded(g.orderBy(F.col("mean_abs_contribution").desc(), "feature").limit(20))


@query("decision_table")
def q_decision_table(spark, sf):
    """H9 flagship: the full retention decision table."""
    return rounded(J.decision_table(scored(spark, sf)))


@query("decision_table_v1")
def q_decision_table_v1(spark, sf):
    """Reason codes and horizon risks without valuation."""
    return rounded(J.decision_table_v1(scored(spark, sf)))


# ---- evaluation and threshold economics ------------------------------------------


_MODEL_PAIRS = (("churn_model", "Churn_Target", "churn_prob"),
                ("timing_30d", "y_30d", "risk_30d"), ("timing_60d", "y_60d", "risk_60d"),
                ("timing_90d", "y_90d", "risk_90d"))


def eval_frame(spark, sf):
    """Hold-out rows: label, score (churn model), MonthlyCharges."""
    return scored(spark, sf).select("customerID", F.col("Churn_Target").alias("label"),
                                    F.col("churn_prob").alias("score"), "MonthlyCharges",
                                    "tenure", *[p[1] for p in _MODEL_PAIRS[1:]],
                                    *[p[2] for p in _MODEL_PAIRS[1:]])


def eval_models(spark, sf):
    """The four models' hold-out predictions in one long frame."""
    sc = scored(spark, sf)
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.col(l).cast("int").alias("label"),
                             F.col(s).alias("score")) for m, l, s in _MODEL_PAIRS])
    return sc.select("customerID", F.inline(arr))


@query("cost_curve")
def q_cost_curve(spark, sf):
    """101-threshold cost curve (FN 200, FP 50)."""
    return rounded(Ev.cost_curve(eval_frame(spark, sf)))


@query("confusion_at_best")
def q_confusion_best(spark, sf):
    """F1 + F3 + F6: counts and rates at the grid-optimal threshold."""
    ev = eval_frame(spark, sf)
    b = Ev.best_threshold(Ev.cost_curve(ev))
    r = Ev.rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return rounded(b.select("threshold", "cost", "tp", "fp", "fn", "tn",
                            *[v.alias(k) for k, v in r.items()]))


@query("cost_kpis")
def q_cost_kpis(spark, sf):
    """Best threshold, min cost, do-nothing cost, savings, revenue at risk."""
    return rounded(Ev.cost_kpis(eval_frame(spark, sf)))


@query("pr_curve")
def q_pr_curve(spark, sf):
    """precision-recall points over distinct scores."""
    return rounded(Ev.pr_curve(eval_frame(spark, sf))
                   .select("threshold", "precision", "recall"))


@query("threshold_report")
def q_threshold_report(spark, sf):
    """F5 + A8: F-beta picks (1, 1.5, 2) and the grid minimum."""
    return rounded(Ev.threshold_report(eval_frame(spark, sf)))


@query("classification_report")
def q_classification_report(spark, sf):
    """F7 at the grid-optimal threshold."""
    ev = eval_frame(spark, sf)
    thr = Ev.best_threshold(Ev.cost_curve(ev)).select("threshold").scalar()
    return rounded(Ev.classification_report(Ev.confusion(ev, thr)))


@query("model_metrics")
def q_model_metrics(spark, sf):
    """F8 + F9 + F10: metric records of the churn and three horizon models."""
    return rounded(Ev.metrics_record(eval_models(spark, sf), 0.5, ["model"]))


@query("roc_curve")
def q_roc_curve(spark, sf):
    """ROC points per distinct score."""
    return rounded(Ev.roc_curve(eval_frame(spark, sf)))


@query("calibration_curve")
def q_calibration(spark, sf):
    """ten uniform bins."""
    return rounded(Ev.calibration_curve(eval_frame(spark, sf)))


@query("score_histogram")
def q_histogram(spark, sf):
    """30 equal-width bins by label."""
    return rounded(Ev.score_histogram(eval_frame(spark, sf)))


@query("decile_stats")
def q_deciles(spark, sf):
    """E10 + E11: quantile deciles (duplicate edges dropped), actual vs predicted."""
    return rounded(Ev.decile_stats(eval_frame(spark, sf)))


@query("class_weight")
def q_class_weight(spark, sf):
    """Class counts and pos_weight on the training rows."""
    lab = labeled(spark, sf).filter(~F.col("is_test"))
    return rounded(Ev.class_weight(lab, "Churn_Target"))


@query("window_summary")
def q_window_summary(spark, sf):
    """Per model, mean predicted risk and positives on the hold-out."""
    return rounded(Ev.window_summary(eval_models(spark, sf)))


# ---- exploratory aggregates ----------------------------------------------------------


@query("eda_churn_rate_v1")
def q_eda_rate(spark, sf):
    """Churn rate per value of every categorical column (v1 profile)."""
    return rounded(D.churn_rate_by_category(engineered(spark, sf, "v1")))


@query("eda_top_categories")
def q_eda_top(spark, sf):
    """First 8 text columns, top 12 values by churn rate."""
    return rounded(D.top_categories(engineered(spark, sf, "v2")))


@query("eda_tenure_bucket")
def q_eda_tenure(spark, sf):
    """D3."""
    return rounded(D.churn_by_tenure_bucket(engineered(spark, sf, "v2")))


@query("eda_correlation")
def q_eda_corr(spark, sf):
    """Pairwise-complete Pearson matrix of numeric columns + target."""
    return rounded(D.correlation_matrix(engineered(spark, sf, "v2")))


@query("eda_distribution")
def q_eda_dist(spark, sf):
    """Per churn label: count, mean, min, max, 5/25/50/75/95 % points."""
    return rounded(D.distribution_by_label(engineered(spark, sf, "v2")))


@query("eda_medians")
def q_eda_medians(spark, sf):
    """Median per numeric model input on the training rows."""
    lab = labeled(spark, sf).filter(~F.col("is_test"))
    cols = ["tenure", "MonthlyCharges", "TotalCharges", "Service_Count", "Avg_Historical_Charge"]
    return rounded(D.medians(lab, cols))


@query("distinct_contracts")
def q_distinct(spark, sf):
    """D15."""
    return D.distinct_values(engineered(spark, sf), "Contract")


# ---- live policy, segments, routing, queues -------------------------------------------


RESULT_COLUMNS = ("customerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract",
                  "PaymentMethod", "InternetService", "Tenure_Bucket", "Service_Count")


def results_v1(spark, sf):
    """Scored hold-out as the apps see it: features, Churn_Prob, Actual_Churn."""
    sc = scored(spark, sf)
    # keys were normalised at ingest (B16), so both tables keep their
    # customerID bucketing and the C1 merge needs no shuffle
    return sc.select(*RESULT_COLUMNS, F.col("churn_prob").alias("Churn_Prob"),
                     F.col("Churn_Target").alias("Actual_Churn"))


def best_thr(spark, sf):
    return Ev.best_threshold_value(eval_frame(spark, sf))


def decisions(spark, sf):
    """Decision table, written once per session (the dashboards read the
    written table, as upstream)."""
    return _cached("decisions", spark, sf, lambda: T_.bucketed(
        J.decision_table(scored(spark, sf)), "decisions"))


def live(spark, sf, params=LiveParams()):
    """The live working table, computed once per session and parameter set
    and written as a table boundary (every dashboard output reads it)."""
    return _cached(("live", params), spark, sf, lambda: T_.materialize(
        P.live_view(results_v1(spark, sf), decisions(spark, sf), best_thr(spark, sf), params),
        "live_view"))


@query("v1_segments")
def q_v1_segments(spark, sf):
    """Critical / Target / Safe with actions at the grid-optimal threshold."""
    return rounded(P.v1_segments(results_v1(spark, sf), best_thr(spark, sf))
                   .select("customerID", "Churn_Prob", "Segment", "Action"))


@query("segment_counts")
def q_segment_counts(spark, sf):
    """D9."""
    return P.value_counts(P.v1_segments(results_v1(spark, sf), best_thr(spark, sf)), "Segment")


@query("segment_profile")
def q_segment_profile(spark, sf):
    """D11 (+ B22 cohorts): mean tenure and charges, High Risk vs Safe."""
    return rounded(P.segment_profile(results_v1(spark, sf), best_thr(spark, sf)))


@query("action_list_v1")
def q_action_list_v1(spark, sf):
    """B18 + E3: segment set AND contract set, by probability."""
    seg = P.v1_segments(results_v1(spark, sf), best_thr(spark, sf))
    out = B.filter_in(seg, Segment=["🔴 Critical Risk", "🟡 Target Zone"],
                      Contract=["Month-to-month"])
    return rounded(out.orderBy(F.col("Churn_Prob").desc(), "customerID")
                   .select("customerID", "Segment", "Churn_Prob", "Action", "tenure",
                           "MonthlyCharges", "Contract", "PaymentMethod"))


@query("segment_positions")
def q_segment_positions(spark, sf):
    """Sorted position by MonthlyCharges within each v1 segment."""
    seg = P.v1_segments(results_v1(spark, sf), best_thr(spark, sf))
    return rounded(P.sorted_positions(seg, "MonthlyCharges")
                   .select("customerID", "Segment", "MonthlyCharges", "position"))


@query("tenure_positions")
def q_tenure_positions(spark, sf):
    """B24 + B25 + E8: tenure in years and display text, position by tenure."""
    seg = P.v1_segments(results_v1(spark, sf), best_thr(spark, sf))
    t = B.with_tenure_display(B.drop_null(seg, "tenure"))
    return rounded(P.sorted_positions(t, "tenure")
                   .select("customerID", "Segment", "tenure", "tenure_years",
                           "tenure_display", "position"))


@query("capacity_segments")
def q_capacity_segments(spark, sf):
    """H12 + E6 + C3: Target above the threshold, top-200 of them Critical."""
    seg = P.capacity_segments(results_v1(spark, sf), best_thr(spark, sf), LiveParams().calls_per_week)
    return rounded(seg.select("customerID", "Churn_Prob", "Segment", "Action"))


@query("live_view")
def q_live_view(spark, sf):
    """C1 + H13 + H3 + B20 + B21 + H14: the live working table."""
    return rounded(live(spark, sf).select(
        "customerID", "Churn_Prob", "Segment", "tenure", "tenure_v2", "risk_30d", "clv",
        "value_segment", "value_segment_live", "value_basis_live", "value_base_live",
        "expected_loss_30d_live", "offer_cost_live", "should_intervene_live", "roi_proxy_live",
        "routing_score_live", "routing_tier_live"))


@query("live_view_fixed_ltv")
def q_live_view_fixed(spark, sf):
    """H13/H14 variant: fixed LTV value base, 60-day routing, no filters."""
    p = LiveParams(use_fixed_ltv=True, risk_window="risk_60d", min_value_segment="all",
                   only_intervene=False, calls_per_week=50)
    return rounded(live(spark, sf, p).select(
        "customerID", "value_basis_live", "value_base_live", "expected_loss_30d_live",
        "should_intervene_live", "roi_proxy_live", "routing_score_live", "routing_tier_live"))


@query("live_kpis")
def q_live_kpis(spark, sf):
    """D7."""
    return rounded(P.live_kpis(live(spark, sf)))


@query("action_list")
def q_action_list(spark, sf):
    """First 500 by live ROI."""
    return rounded(B.project_existing(P.action_list(live(spark, sf), 500),           # B28
                                      ["customerID", "routing_tier_live", "roi_proxy_live",
                                       "roi_proxy", "risk_30d"]))


@query("critical_queue")
def q_critical_queue(spark, sf):
    """Critical call queue, first 200 by routing score."""
    return rounded(P.queue(live(spark, sf), "🔴 Critical Risk", 200)
                   .select("customerID", "routing_score_live", "roi_proxy_live"))


@query("target_queue")
def q_target_queue(spark, sf):
    """Target campaign queue, first 200 by routing score."""
    return rounded(P.queue(live(spark, sf), "🟡 Target Zone", 200)
                   .select("customerID", "routing_score_live", "roi_proxy_live"))


@query("case_file")
def q_case_file(spark, sf):
    """B23 + H15: case file of the first customer of the action list."""
    lv = live(spark, sf)
    first = P.action_list(lv, 1).select("customerID").first()
    return rounded(P.case_file(lv, first["customerID"] if first else ""))


# limits that lie below their inputs: what is beyond them is really left out
SMALL = LiveParams(calls_per_week=15)


@query("routing_queues_limited")
def q_routing_queues(spark, sf):
    """E7 + H14 with 15 calls a week and queues of 10: both tiers are filled
    and both limits act; the order is a column."""
    lv = live(spark, sf, SMALL)
    cols = ("routing_tier_live", "position", "customerID", "routing_score_live", "roi_proxy_live")
    return rounded(P.queue(lv, "🔴 Critical Risk", 10, position="position").select(*cols).union(
        P.queue(lv, "🟡 Target Zone", 10, position="position").select(*cols)))


@query("action_list_limited")
def q_action_list_limited(spark, sf):
    """E4 + B28: the first 12 by live ROI with all columns of the list."""
    lv = live(spark, sf, SMALL)
    return rounded(B.project_existing(P.action_list(lv, 12, position="position"),
                                      P.ACTION_LIST_COLUMNS))


@query("ops_top_limited")
def q_ops_top_limited(spark, sf):
    """E1 + E5: the first 20 of the ops order, with their places."""
    d = decisions(spark, sf)
    return rounded(P.top_rows(d, J.ops_order(d), 20, "position").select(
        "position", "customerID", "should_intervene", "priority_score", "expected_loss_30d"))


@query("risk_value_limited")
def q_risk_value_limited(spark, sf):
    """H16 + E5: the first 15 points of the filtered ops order."""
    d = filtered_decisions(spark, sf)
    return rounded(P.top_rows(d, J.ops_order(d), 15, "position").select(
        "position", "customerID", "risk_30d", "clv", "expected_loss_30d"))


@query("ops_positions")
def q_ops_positions(spark, sf):
    """Place of every customer in the ops order (a global order as data)."""
    d = decisions(spark, sf)
    return P.with_position(d, J.ops_order(d)).select("customerID", "position")


@query("risk_positions")
def q_risk_positions(spark, sf):
    """Place of every customer by near-term risk."""
    return rounded(P.with_position(
        J.decision_table_v1(scored(spark, sf)).select("customerID", "risk_30d"),
        [F.col("risk_30d").desc(), F.col("customerID").asc()]))


@query("action_list_v1_positions")
def q_action_list_positions(spark, sf):
    """The filtered list by probability, with places."""
    seg = P.v1_segments(results_v1(spark, sf), best_thr(spark, sf))
    out = B.filter_in(seg, Segment=["🔴 Critical Risk", "🟡 Target Zone"],
                      Contract=["Month-to-month"]).select("customerID", "Churn_Prob")
    return rounded(P.with_position(out, [F.col("Churn_Prob").desc(), F.col("customerID").asc()]))


@query("bucket_mix")
def q_bucket_mix(spark, sf):
    """D12 + I1: bucket frequency over bucket_1..3 of the live view."""
    return P.stacked_counts(live(spark, sf), ["bucket_1", "bucket_2", "bucket_3"], "bucket")


@query("top_reasons")
def q_top_reasons(spark, sf):
    """15 most frequent reasons of the live view."""
    return P.top_reasons(live(spark, sf), 15)


def filtered_decisions(spark, sf):
    """B19 (minimum segment mid) + B21 (only intervene) on the decision table."""
    return B.only_flagged(B.min_segment_rank(decisions(spark, sf), "mid"))


@query("portfolio_kpis")
def q_portfolio_kpis(spark, sf):
    """D6 over B19 + B21."""
    return rounded(P.portfolio_kpis(filtered_decisions(spark, sf)))


@query("intervention_mix")
def q_intervention_mix(spark, sf):
    """D10."""
    return P.value_counts(filtered_decisions(spark, sf), "intervention_type")


@query("risk_value_points")
def q_risk_value(spark, sf):
    """H16 + E1 + E5: first 2000 rows of the ops order."""
    d = filtered_decisions(spark, sf)
    return rounded(P.top_rows(d, J.ops_order(d), 2000).select(
        "customerID", "risk_30d", "clv", "expected_loss_30d", "intervention_type",
        "reason_1", "recommended_action"))


@query("ops_top")
def q_ops_top(spark, sf):
    """E1 + E5: first 300 rows of the ops order (intervene, priority, loss)."""
    d = decisions(spark, sf)
    return rounded(P.top_rows(d, J.ops_order(d), 300).select(
        "customerID", "should_intervene", "priority_score", "expected_loss_30d",
        "value_segment", "intervention_type"))


@query("risk_sorted")
def q_risk_sorted(spark, sf):
    """The earlier table sorted by near-term risk."""
    return rounded(J.decision_table_v1(scored(spark, sf))
                   .orderBy(F.col("risk_30d").desc(), "customerID")
                   .select("customerID", "risk_30d", "reason_1", "recommended_action"))


@query("key_profile")
def q_key_profile(spark, sf):
    """Key uniqueness of the decision table."""
    return P.key_profile(decisions(spark, sf))


@query("clv_quantiles")
def q_clv_quantiles(spark, sf):
    """CLV 33 % / 66 % points of the merged view (linear interpolation)."""
    m = P.merge_suffixed(results_v1(spark, sf), decisions(spark, sf))
    return rounded(H.value_quantiles(m, "clv"))


# ---- MLlib gradient-boosted models (rows-only checks) -------------------------------


LABELS = (J.CHURN_LABEL, *J.WINDOW_LABELS)


def prepared(spark, sf):
    """The labelled table, written once for everything that fits from it."""
    return _cached("prepared", spark, sf, lambda: T_.materialize(labeled(spark, sf), "labeled"))


def encoding(spark, sf):
    return _cached("encoding", spark, sf, lambda: EN.plan_encoding(
        prepared(spark, sf).filter(~F.col("is_test"))))


def matrix(spark, sf):
    """Binned inputs of every customer, with labels and split."""
    return _cached("matrix", spark, sf, lambda: EN.build_matrix(
        prepared(spark, sf), encoding(spark, sf), ["customerID", "is_test", *LABELS]))


def gbt_models(spark, sf, labels=LABELS):
    """The models of `labels` (churn and the three horizons), from one encoding
    and matrix; a label is fitted when a query first asks for it."""
    have = _cached("gbt", spark, sf, dict)
    missing = [y for y in labels if y not in have]
    if missing:
        have.update(ML.fit_models(None, missing, encoding=encoding(spark, sf),
                                  matrix=matrix(spark, sf).filter(~F.col("is_test"))))
    return {y: have[y] for y in labels}


def gbt(spark, sf, label=J.CHURN_LABEL):
    return gbt_models(spark, sf, [label])[label]


def gbt_leaves(spark, sf, label=J.CHURN_LABEL):
    return _cached(f"leaves_{label}", spark, sf, lambda: T_.materialize(
        gbt(spark, sf, label).leaves(), "leaves"))


@query("model_inputs_plan")
def q_model_inputs_plan(spark, sf):
    """G2 + D17: how each input column is encoded."""
    t = encoding(spark, sf).table(spark)
    return rounded(t.select("name", "kind", "fill", F.size("cuts").alias("n_cuts"),
                            F.size("values").alias("n_values")))


@query("model_matrix")
def q_model_matrix(spark, sf):
    """The written fit matrix, long: bins of numeric inputs and the slots
    that are set, under their encoded names."""
    enc = encoding(spark, sf)
    names = F.array(*map(F.lit, enc.names()))
    return (matrix(spark, sf).select("customerID", F.posexplode("x").alias("slot", "value"))
            .filter((F.col("value") != 0) | (F.col("slot") < len(enc.numeric)))
            .select("customerID", F.get(names, F.col("slot")).alias("feature"),
                    F.col("value").cast("int").alias("value")))


@query("gbt_model_checks")
def q_gbt_model_checks(spark, sf):
    """G3, G4, G10, A9 as invariants: of each model's hold-out rows, how many
    have a score in [0, 1], the same score from the leaf table, and the same
    score from the model as saved."""
    hold = matrix(spark, sf).filter("is_test").select("customerID", "x")
    out = None
    for label, model in gbt_models(spark, sf).items():
        leaves = gbt_leaves(spark, sf, label)
        p = model.score_matrix(hold, "p").select("customerID", "x", "p")
        again = ML.load_churn_model(model.path).score_matrix(p, "q").select("customerID", "p", "q")
        both = again.join(TR.leaf_scores(hold, leaves), "customerID", "left")
        near = F.abs(1 / (1 + F.exp(-F.col("margin"))) - F.col("p")) < 1e-9
        one = both.agg(F.count("*").alias("rows"), F.count_if(F.col("p").between(0, 1)).alias("in_unit"),
                       F.count_if(near).alias("same_from_leaves"),
                       F.count_if(F.col("p") == F.col("q")).alias("same_from_folder"))
        one = one.select(F.lit(label).alias("label"), "*")
        out = one if out is None else out.union(one)
    return out


@query("gbt_shapley_checks")
def q_gbt_shapley_checks(spark, sf):
    """G7b as an invariant: of all hold-out rows, how many have contributions
    that add up to the margin less the base value."""
    leaves = gbt_leaves(spark, sf)
    hold = matrix(spark, sf).filter("is_test")
    total = gbt_contributions(spark, sf).groupBy("customerID").agg(
        F.sum("contribution").alias("total"))
    base = TR.base_value(leaves).first()["base"]
    both = TR.leaf_scores(hold, leaves).join(total, "customerID")
    return both.agg(F.count("*").alias("rows"), F.count_if(
        F.abs(F.col("total") + base - F.col("margin")) < 1e-6).alias("additive"))


def gbt_contributions(spark, sf):
    return _cached("gbt_contributions", spark, sf, lambda: T_.materialize(TR.tree_shapley(
        matrix(spark, sf).filter("is_test"), gbt_leaves(spark, sf),
        encoding(spark, sf).names()), "gbt_contributions"))


@query("gbt_node_table")
def q_gbt_nodes(spark, sf):
    """G3 + G4: the fitted trees as rows."""
    return gbt(spark, sf).nodes()


@query("gbt_scores")
def q_gbt_scores(spark, sf):
    """G2 + G3 + G4: encode, fit a weighted GBT, score the hold-out."""
    test = labeled(spark, sf).filter(F.col("is_test"))
    return gbt(spark, sf).transform(test).select("customerID", "churn_prob")


@query("gbt_feature_importance")
def q_gbt_importance(spark, sf):
    """top-20 feature importances."""
    return gbt(spark, sf).feature_importance(spark, 20)


@query("gbt_saved_model_scores")
def q_gbt_saved(spark, sf):
    """Save the model to the shared folder, load it from there alone, score."""
    path = T_.scratch_path(spark, "gbt_model")
    gbt(spark, sf).save(path)
    loaded = ML.load_churn_model(path)
    test = labeled(spark, sf).filter(F.col("is_test"))
    return loaded.transform(test).select("customerID", "churn_prob")


@query("gbt_window_scores")
def q_gbt_windows(spark, sf):
    """One model per horizon (30/60/90 days), hold-out risks."""
    out = matrix(spark, sf).filter("is_test").select("customerID", "x")
    for label, model in gbt_models(spark, sf, J.WINDOW_LABELS).items():
        out = model.score_matrix(out, J.SCORE_COLUMNS[label])
    return out.select("customerID", "risk_30d", "risk_60d", "risk_90d")


# encoded names that reach every bucket, action and offer rule
RULE_NAMES = (
    "cat__Contract_Month-to-month", "cat__Contract_Two year", "cat__PaymentMethod_Electronic check",
    "cat__PaymentMethod_Mailed check", "num__MonthlyCharges", "num__TotalCharges",
    "num__Avg_Historical_Charge", "cat__TechSupport_No", "cat__TechSupport_Yes",
    "cat__OnlineSecurity_No", "cat__DeviceProtection_Yes", "cat__InternetService_Fiber optic",
    "cat__StreamingTV_Yes", "num__tenure", "cat__Tenure_Bucket_0-1y", "cat__MultipleLines_Yes",
    "cat__Partner_Yes", "num__Service_Count", "",
)


@query("rule_chains")
def q_rule_chains(spark, sf):
    """Every rule, one name and value segment per customer."""
    n = len(RULE_NAMES)
    key = F.col("c_custkey")
    rows = spark.read.parquet(f"{sf.rstrip('/')}/customer.parquet").select(
        key.cast("string").alias("customerID"),
        F.get(F.array(*map(F.lit, RULE_NAMES)), (key % n).cast("int")).alias("name"),
        F.get(F.array(F.lit("low"), F.lit("mid"), F.lit("high")),
              (F.floor(key / n) % 3).cast("int")).alias("value_segment"))
    rows = rows.withColumn("reason", R.clean_feature_name(F.col("name")))
    rows = rows.withColumns({"bucket": R.bucket_reason(F.col("reason")),
                             "action": R.recommend_action([F.col("reason")])})
    rows = rows.withColumn("offer", R.choose_intervention(F.col("action"), F.col("value_segment")))
    return rows.withColumn("offer_cost", R.offer_cost(F.col("offer"), OFFER_COSTS))


# ---- sources and sinks (round trips through the shared folder) ------------------------


@query("csv_roundtrip_engineered")
def q_csv_roundtrip(spark, sf):
    """A4 -> A1/A2 -> B29: subscribers exported as CSV, found by candidate
    name, read with an explicit schema (PERMISSIVE), engineered."""
    folder = T_.scratch_path(spark, "raw")
    T_.write_csv(subscribers(spark, sf).drop("days_to_churn"), f"{folder}/Churn_Telco.csv")
    schema = subscribers(spark, sf).drop("days_to_churn").schema
    raw = SRC.load_raw(spark, folder, schema=schema)
    return rounded(B.engineered(raw, "v2"))


@query("csv_quarantine")
def q_csv_quarantine(spark, sf):
    """A2: a raw file in which some lines are cut short. Those are in the
    quarantine and in no other table; the other customers are engineered."""
    folder = T_.scratch_path(spark, "raw")
    rows = subscribers(spark, sf).drop("days_to_churn")
    T_.write_csv(rows, f"{folder}/Churn_Telco.csv")
    head = spark.createDataFrame([(0, ",".join(rows.columns))], "o int, value string")
    cut = rows.filter(F.col("customerID").cast("long") % 10 == 0).select(
        F.lit(1).alias("o"), F.concat("customerID", F.lit(",cut short")).alias("value"))
    (head.union(cut).coalesce(1).sortWithinPartitions("o").select("value")
     .write.mode("append").text(f"{folder}/Churn_Telco.csv"))
    got = SRC.ingest_raw(spark, folder, T_.scratch_path(spark, "ingested"), schema=rows.schema)
    counted = B.engineered(got.rows, "v2").agg(
        F.count("*").alias("engineered"), F.count("customerID").alias("with_key"))
    lines = got.quarantine.agg(F.count("*").alias("quarantined"), F.min("line").alias("first_line"))
    # two tables of one row, side by side without a join
    both = counted.unionByName(lines, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        "engineered", "with_key", "quarantined", "first_line",
        F.lit(got.n_rows).cast("long").alias("rows_seen"),
        F.lit(got.n_malformed).cast("long").alias("malformed_seen"))


@query("odd_charges")
def q_odd_charges(spark, sf):
    """B1 + B10 on text that is no finite number: '1e999' is NULL as well."""
    key = F.col("customerID").cast("long")
    text = F.when(key % 3 == 0, "1e999").when(key % 3 == 1, "-1e400").otherwise(F.col("TotalCharges"))
    eng = B.engineered(subscribers(spark, sf).withColumn("TotalCharges", text))
    return rounded(eng.select("customerID", "TotalCharges", "Avg_Historical_Charge"))


@query("split_exact_null_labels")
def q_split_null_labels(spark, sf):
    """G1, exact-count variant with rows that have no label: a class of its own."""
    from .operators import split as S
    eng = B.engineered(subscribers(spark, sf)).withColumn("label", F.when(
        F.col("customerID").cast("long") % 7 != 0, F.col("Churn_Target")))
    return S.with_exact_split(eng, "label").groupBy("is_test", "label").agg(
        F.count(F.lit(1)).alias("customers"))


@query("metrics_json_roundtrip")
def q_metrics_json(spark, sf):
    """Model metric records written as JSON and read back (A3)."""
    path = T_.scratch_path(spark, "model_metrics")
    T_.write_json(Ev.metrics_record(eval_models(spark, sf), 0.5, ["model"]), path)
    return rounded(spark.read.json(path))


@query("threshold_report_table")
def q_report_table(spark, sf):
    """The threshold report as a table (A4) read back (A3)."""
    path = T_.scratch_path(spark, "threshold_report")
    T_.write_table(Ev.threshold_report(eval_frame(spark, sf)), path)
    return rounded(SRC.read_table(spark, path))


@query("ensure_decision_table")
def q_ensure(spark, sf):
    """A10: build-if-missing table (built on first use, then read)."""
    path = T_.scratch_path(spark, "retention_table_v2")
    T_.ensure_table(spark, path, lambda: J.decision_table(scored(spark, sf)))   # builds

    def must_not_rebuild():
        raise RuntimeError(f"{path} should exist")

    table = T_.ensure_table(spark, path, must_not_rebuild)                       # reads
    return rounded(table.select("customerID", "clv", "intervention_type", "should_intervene"))


@query("export_filtered_list")
def q_export(spark, sf):
    """A5: filtered action list exported as CSV and read back."""
    path = T_.scratch_path(spark, "filtered_churn_risk")
    lst = q_action_list_v1(spark, sf)
    T_.write_csv(lst, path)
    return rounded(spark.read.schema(lst.schema).option("header", True).csv(path))


@query("gbt_reason_codes")
def q_gbt_reason_codes(spark, sf):
    """G7b + G5 + G8 + G9: exact tree Shapley contributions of the GBT model
    on the hold-out, then reason codes."""
    from .operators import shapley as SH
    long = gbt_contributions(spark, sf)
    rc = X.add_reason_codes(SH.contribution_arrays(long))
    return X.add_buckets_and_actions(rc)


@query("model_inputs")
def q_model_inputs(spark, sf):
    """The model frame without label/leak columns (absent names ignored)."""
    lab = labeled(spark, sf)
    return rounded(B.drop_columns(lab, list(B.LEAK_COLUMNS) + ["is_test", "not_a_column"]))


@query("carry_forward_context")
def q_carry_forward(spark, sf):
    """B17 + C2: context columns joined onto the reason codes by key (only
    the ones missing there), never by position."""
    rc = J.reason_code_table(scored(spark, sf))
    return rounded(B.carry_forward(rc, labeled(spark, sf), J.CONTEXT_COLUMNS + ("churn_prob",)))


@query("high_risk_drilldown")
def q_high_risk(spark, sf):
    """The drill-down cohort uses a strict p > threshold."""
    return rounded(B.cohort(results_v1(spark, sf), "Churn_Prob", best_thr(spark, sf), "above")
                   .select("customerID", "Churn_Prob"))


@query("metrics_json_document")
def q_metrics_document(spark, sf):
    """J7 + A7: metric records encoded as one JSON document keyed by model,
    written as text, read back and decoded."""
    path = T_.scratch_path(spark, "model_metrics_doc")
    doc = Ev.metrics_document(Ev.metrics_record(eval_models(spark, sf), 0.5, ["model"]))
    doc.write.mode("overwrite").text(path)
    back = spark.read.text(path).withColumnRenamed("value", "document")
    return rounded(Ev.parse_metrics_document(back))


# ---- the whole population (every customer scored, not only the hold-out) -------------

def scored_all(spark, sf):
    return _cached("scored_all", spark, sf, lambda: T_.bucketed(
        J.scored(labeled(spark, sf), model(spark, sf), test_only=False), "scored_all"))


@query("scores_all")
def q_scores_all(spark, sf):
    """G4 over every customer: churn and horizon probabilities."""
    return rounded(scored_all(spark, sf).select("customerID", "churn_prob", "risk_30d",
                                                "risk_60d", "risk_90d"))


@query("decision_table_all")
def q_decision_table_all(spark, sf):
    """H9 over every customer (the production table)."""
    return rounded(J.decision_table(scored_all(spark, sf)))



@query("split_exact")
def q_split_exact(spark, sf):
    """G1 exact-count stratified variant: per class counts of test rows."""
    from .operators import split as S
    lab = S.with_exact_split(B.engineered(subscribers(spark, sf)), "Churn_Target")
    return lab.groupBy("is_test", "Churn_Target").agg(F.count(F.lit(1)).alias("customers"))


FLAGSHIP = "decision_table_all"   # entry(): the full decision table (H9)
