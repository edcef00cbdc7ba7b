"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from . import sql

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needed: str) -> None:
    ORACLE[name] = sql(body, *needed)


def r(expr: str, alias: str | None = None) -> str:
    """Round a double to 6 places (as the Spark side does at the edge)."""
    return f"round({expr}, 6) AS {alias or expr}"


_SUB_COLS = ("customerID", "tenure", "MonthlyCharges", "TotalCharges", "InternetService",
             "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup",
             "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Partner",
             "Dependents", "Contract", "PaymentMethod", "Churn", "days_to_churn")
_DOUBLES = {"tenure", "MonthlyCharges", "days_to_churn", "Avg_Historical_Charge",
            "TotalCharges_num"}


def _proj(cols, doubles):
    return ", ".join(r(c) if c in doubles else c for c in cols)


oracle("fixture_subscribers",
       f"SELECT {_proj(_SUB_COLS, {'tenure', 'MonthlyCharges', 'days_to_churn'})} FROM subscribers",
       "subscribers")

_ENG_COLS = _SUB_COLS + ("Churn_Target", "Tenure_Bucket", "Service_Count",
                         "Avg_Historical_Charge", "Payment_Simple")
_ENG_DOUBLES = {"tenure", "MonthlyCharges", "TotalCharges", "days_to_churn",
                "Avg_Historical_Charge"}

oracle("engineered_v2", f"SELECT {_proj(_ENG_COLS, _ENG_DOUBLES)} FROM eng", "eng")
oracle("engineered_v1", f"SELECT {_proj(_ENG_COLS, _ENG_DOUBLES)} FROM eng_v1", "eng_v1")

oracle("contract_tenure_value", f"""
SELECT Contract, Tenure_Bucket, count(*) AS customers,
       {r('avg(Churn_Target)', 'churn_rate')}, {r('sum(clv)', 'total_clv')}
FROM valued GROUP BY Contract, Tenure_Bucket""", "valued")

# ---- split, labels, model, scores, explanations --------------------------------
from . import model as M  # noqa: E402,F401

oracle("split_flags", """
SELECT is_test, Churn_Target, count(*) AS customers FROM lab GROUP BY is_test, Churn_Target""", "lab")

oracle("window_labels", f"""
SELECT customerID, Churn_Target, {r('days_to_churn')}, y_30d, y_60d, y_90d FROM lab""", "lab")

oracle("scorecard_model", f"""
SELECT feature, value, {r('n')}, {r('pos_c')}, {r('pos_30')}, {r('pos_60')}, {r('pos_90')},
  {r('c_c')}, {r('c_30')}, {r('c_60')}, {r('c_90')} FROM model""", "model")

oracle("scores_test", f"""
SELECT customerID, {r('churn_prob')}, {r('risk_30d')}, {r('risk_60d')}, {r('risk_90d')} FROM scores""",
       "scores")

oracle("contributions", f"""
SELECT customerID, fname AS feature, {r('c_c', 'contribution')} FROM contrib WHERE is_test""",
       "contrib")

oracle("reason_codes", f"""
SELECT customerID, {r('churn_prob')}, reason_1, {r('impact_1')}, reason_2, {r('impact_2')},
  reason_3, {r('impact_3')}, bucket_1, bucket_2, bucket_3, recommended_action FROM rc""", "rc")

oracle("global_drivers", f"""
SELECT fname AS feature,
  {r('sum(abs(c_c)) / (SELECT count(*) FROM scores)', 'mean_abs_contribution')}
FROM contrib WHERE is_test GROUP BY fname""", "contrib", "scores")

_DEC_DOUBLES = ("churn_prob", "impact_1", "impact_2", "impact_3", "risk_30d", "risk_60d",
                "risk_90d", "tenure", "MonthlyCharges", "TotalCharges", "monthly_margin",
                "remaining_months_proxy", "clv", "expected_loss_30d", "expected_loss_60d",
                "expected_loss_90d", "priority_score", "offer_cost", "roi_proxy")
_DEC_OTHER = ("customerID", "reason_1", "reason_2", "reason_3", "bucket_1", "bucket_2",
              "bucket_3", "recommended_action", "Contract", "PaymentMethod", "InternetService",
              "value_segment", "intervention_type", "should_intervene")
oracle("decision_table",
       "SELECT " + ", ".join(list(_DEC_OTHER) + [r(c) for c in _DEC_DOUBLES]) + " FROM decision",
       "decision")

_V1 = ("customerID", "reason_1", "reason_2", "reason_3", "bucket_1", "bucket_2", "bucket_3",
       "recommended_action")
oracle("decision_table_v1",
       "SELECT " + ", ".join(list(_V1) + [r(c) for c in ("churn_prob", "impact_1", "impact_2",
                                                         "impact_3", "risk_30d", "risk_60d",
                                                         "risk_90d")])
       + " FROM (SELECT rc.* EXCLUDE (churn_prob), s.* EXCLUDE (customerID) "
         "FROM rc JOIN scores s USING (customerID))", "rc", "scores")

# ---- evaluation -------------------------------------------------------------------
from . import cte  # noqa: E402

cte("ev", """
SELECT s.customerID, l.Churn_Target AS label, s.churn_prob AS score, l.MonthlyCharges, l.tenure
FROM scores s JOIN lab l USING (customerID)""", ("scores", "lab"))
cte("ev_models", """
SELECT s.customerID, 'churn_model' AS model, l.Churn_Target AS label, s.churn_prob AS score
FROM scores s JOIN lab l USING (customerID)
UNION ALL SELECT s.customerID, 'timing_30d', l.y_30d, s.risk_30d FROM scores s JOIN lab l USING (customerID)
UNION ALL SELECT s.customerID, 'timing_60d', l.y_60d, s.risk_60d FROM scores s JOIN lab l USING (customerID)
UNION ALL SELECT s.customerID, 'timing_90d', l.y_90d, s.risk_90d FROM scores s JOIN lab l USING (customerID)
""", ("scores", "lab"))
cte("curve", """
SELECT g.i * CAST(0.01 AS DOUBLE) AS threshold,
  count_if(e.score >= g.i * CAST(0.01 AS DOUBLE) AND e.label = 1) AS tp,
  count_if(e.score >= g.i * CAST(0.01 AS DOUBLE) AND e.label <> 1) AS fp,
  count_if(e.score < g.i * CAST(0.01 AS DOUBLE) AND e.label = 1) AS fn,
  count_if(e.score < g.i * CAST(0.01 AS DOUBLE) AND e.label <> 1) AS tn
FROM range(0, 101) g(i), ev e GROUP BY g.i""", ("ev",))
cte("curve_c", "SELECT *, CAST(fn * 200.0 + fp * 50.0 AS DOUBLE) AS cost FROM curve", ("curve",))
cte("best", "SELECT * FROM curve_c ORDER BY cost, threshold LIMIT 1", ("curve_c",))

oracle("cost_curve", f"SELECT {r('threshold')}, tp, fp, fn, tn, {r('cost')} FROM curve_c", "curve_c")

_RATES = ("CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END",
          "CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END",
          "CASE WHEN tn + fp <> 0 THEN tn / (tn + fp) ELSE 0.0 END")
oracle("confusion_at_best", f"""
SELECT {r('threshold')}, {r('cost')}, tp, fp, fn, tn, {r(_RATES[0], 'precision')},
  {r(_RATES[1], 'recall')}, {r(_RATES[2], 'specificity')} FROM best""", "best")

oracle("cost_kpis", f"""
SELECT {r('b.threshold', 'best_threshold')}, {r('b.cost', 'min_cost')},
  {r('CAST(k.churners AS DOUBLE) * 200.0', 'do_nothing_cost')}, {r('CAST(k.churners AS DOUBLE) * 200.0 - b.cost', 'savings')},
  {r('k.rev', 'revenue_at_risk')}
FROM best b, (SELECT count_if(e.label = 1) AS churners,
                     coalesce(sum(CASE WHEN e.score >= (SELECT threshold FROM best) THEN e.MonthlyCharges END), 0.0) AS rev
              FROM ev e) k""", "best", "ev")

cte("pts", """
SELECT score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM ev GROUP BY score""", ("ev",))
cte("pr", """
SELECT score AS threshold, pos, neg,
  CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) AS tps,
  CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) AS fps,
  CAST(sum(pos) OVER () AS DOUBLE) AS P, CAST(sum(neg) OVER () AS DOUBLE) AS N
FROM pts""", ("pts",))
cte("pr2", """
SELECT *, CASE WHEN tps + fps <> 0 THEN tps / (tps + fps) ELSE 0.0 END AS precision,
  CASE WHEN P = 0 THEN 1.0 ELSE tps / P END AS recall FROM pr""", ("pr",))

oracle("pr_curve", f"SELECT {r('threshold')}, {r('precision')}, {r('recall')} FROM pr2", "pr2")


def _fb(b):
    b2 = b * b
    return (f"CASE WHEN {b2} * precision + recall <> 0 THEN (1 + {b2}) * precision * recall "
            f"/ ({b2} * precision + recall) ELSE 0.0 END")


_fparts = []
for _b in (1.0, 1.5, 2.0):
    _fparts.append(f"""(SELECT 'Beta {_b}' AS method, threshold,
  (P - tps) * 200.0 + fps * 50.0 AS cost, recall, precision
 FROM pr2 ORDER BY {_fb(_b)} DESC, threshold ASC LIMIT 1)""")
_fparts.append("""(SELECT 'MIN COST' AS method, threshold, cost,
  CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision FROM best)""")
oracle("threshold_report", f"""
SELECT method, {r('threshold')}, {r('cost')}, {r('recall')}, {r('precision')}
FROM ({' UNION ALL '.join(_fparts)})""", "pr2", "best")

cte("cm_best", """
SELECT CAST(count_if(e.score >= b.threshold AND e.label = 1) AS DOUBLE) AS tp,
  CAST(count_if(e.score >= b.threshold AND e.label <> 1) AS DOUBLE) AS fp,
  CAST(count_if(e.score < b.threshold AND e.label = 1) AS DOUBLE) AS fn,
  CAST(count_if(e.score < b.threshold AND e.label <> 1) AS DOUBLE) AS tn
FROM ev e, best b""", ("ev", "best"))
cte("cr0", """
SELECT *, CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
  CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN tn + fn <> 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
  CASE WHEN tn + fp <> 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
  tp + fn AS s1, tn + fp AS s0 FROM cm_best""", ("cm_best",))
cte("cr1", """
SELECT *, CASE WHEN p1 + r1 <> 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
  CASE WHEN p0 + r0 <> 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0, s0 + s1 AS n FROM cr0""",
    ("cr0",))
oracle("classification_report", f"""
SELECT class, {r('precision')}, {r('recall')}, {r('f1_score')}, CAST(support AS BIGINT) AS support FROM (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM cr1
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM cr1
  UNION ALL SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
    CASE WHEN n <> 0 THEN (tp + tn) / n ELSE 0.0 END, n FROM cr1
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM cr1
  UNION ALL SELECT 'weighted avg', CASE WHEN n <> 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0.0 END,
    CASE WHEN n <> 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0.0 END,
    CASE WHEN n <> 0 THEN (f0 * s0 + f1 * s1) / n ELSE 0.0 END, n FROM cr1)""", "cr1")

cte("mm_pts", """
SELECT model, score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
FROM ev_models GROUP BY model, score""", ("ev_models",))
cte("mm_auc", """
SELECT model, CASE WHEN max(P) > 0 AND max(N) > 0
  THEN sum(pos * (N - fps + neg / 2.0)) / (max(P) * max(N)) END AS auc FROM (
  SELECT model, pos, neg,
    CAST(sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS DOUBLE) AS fps,
    CAST(sum(pos) OVER (PARTITION BY model) AS DOUBLE) AS P,
    CAST(sum(neg) OVER (PARTITION BY model) AS DOUBLE) AS N FROM mm_pts)
GROUP BY model""", ("mm_pts",))
cte("mm_cm", """
SELECT model, CAST(count_if(score >= 0.5 AND label = 1) AS DOUBLE) AS tp,
  CAST(count_if(score >= 0.5 AND label <> 1) AS DOUBLE) AS fp,
  CAST(count_if(score < 0.5 AND label = 1) AS DOUBLE) AS fn,
  CAST(count_if(score < 0.5 AND label <> 1) AS DOUBLE) AS tn
FROM ev_models GROUP BY model""", ("ev_models",))
oracle("model_metrics", f"""
SELECT model, {r('auc')}, {r('prec', 'precision')}, {r('rec', 'recall')},
  {r('CASE WHEN prec + rec <> 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END', 'f1')},
  CAST(0.5 AS DOUBLE) AS thr, CAST(tp + fn AS BIGINT) AS positives,
  CAST(tp + fp + fn + tn AS BIGINT) AS n
FROM (SELECT c.*, a.auc, CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec,
        CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec
      FROM mm_cm c LEFT JOIN mm_auc a USING (model))""", "mm_cm", "mm_auc")

oracle("roc_curve", f"""
SELECT {r('threshold')}, {r('CASE WHEN N <> 0 THEN fps / N ELSE 0.0 END', 'fpr')},
  {r('CASE WHEN P <> 0 THEN tps / P ELSE 0.0 END', 'tpr')} FROM pr
UNION ALL SELECT CAST('inf' AS DOUBLE), CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE)""", "pr")

_CAL = " + ".join(f"CAST({i} * CAST(0.1 AS DOUBLE) < score AS INTEGER)" for i in range(1, 10))
oracle("calibration_curve", f"""
SELECT bin, {r('avg(CAST(label AS DOUBLE))', 'prob_true')}, {r('avg(score)', 'prob_pred')},
  count(*) AS n FROM (SELECT *, {_CAL} AS bin FROM ev) GROUP BY bin""", "ev")

oracle("score_histogram", f"""
SELECT bin, label, count(*) AS n, {r('lo + bin * (hi - lo) / 30', 'bin_lo')},
  {r('lo + (bin + 1) * (hi - lo) / 30', 'bin_hi')}
FROM (SELECT e.label, m.lo, m.hi,
        CAST(CASE WHEN m.hi - m.lo = 0 THEN 0
             ELSE least(floor((e.score - m.lo) * 30 / (m.hi - m.lo)), 29) END AS INTEGER) AS bin
      FROM ev e, (SELECT min(score) AS lo, max(score) AS hi FROM ev) m)
GROUP BY bin, label, lo, hi""", "ev")

_QS = ", ".join(f"CAST('{repr(i * 0.1)}' AS DOUBLE)" for i in range(11))
oracle("decile_stats", f"""
SELECT decile, {r('avg(CAST(label AS DOUBLE))', 'actual')}, {r('avg(score)', 'pred')} FROM (
  SELECT e.*, CAST(greatest(len(list_filter(d.edges, lambda x: x < e.score)) - 1, 0) AS INTEGER) AS decile
  FROM ev e, (SELECT list_distinct(quantile_cont(score, [{_QS}])) AS edges FROM ev) d)
GROUP BY decile""", "ev")

oracle("class_weight", f"""
SELECT count_if(Churn_Target = 0) AS n0, count_if(Churn_Target = 1) AS n1,
  {r('count_if(Churn_Target = 0) / greatest(count_if(Churn_Target = 1), 1)', 'pos_weight')}
FROM lab WHERE NOT is_test""", "lab")

oracle("window_summary", f"""
SELECT model, {r('avg(score)', 'avg_pred_risk')}, CAST(sum(label) AS BIGINT) AS positives_in_test
FROM ev_models GROUP BY model""", "ev_models")

# ---- exploratory aggregates ----------------------------------------------------------
_CATS = ("InternetService", "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup",
         "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Partner",
         "Dependents", "Contract", "PaymentMethod", "Tenure_Bucket", "Payment_Simple")


def _unpivot(src, cols, extra="Churn_Target", vtype="VARCHAR"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {vtype}) AS value, {extra} FROM {src}" for c in cols)


oracle("eda_churn_rate_v1", f"""
SELECT feature, value, {r('avg(CAST(Churn_Target AS DOUBLE))', 'churn_rate')}, count(*) AS customers
FROM ({_unpivot('eng_v1', _CATS)}) WHERE value IS NOT NULL GROUP BY feature, value""", "eng_v1")

oracle("eda_top_categories", f"""
SELECT feature, value, {r('churn_rate')}, customers, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY churn_rate DESC, value) AS rank FROM (
    SELECT feature, value, avg(CAST(Churn_Target AS DOUBLE)) AS churn_rate, count(*) AS customers
    FROM ({_unpivot('eng', _CATS[:8])}) WHERE value IS NOT NULL GROUP BY feature, value))
WHERE rank <= 12""", "eng")

oracle("eda_tenure_bucket", f"""
SELECT Tenure_Bucket, {r('avg(CAST(Churn_Target AS DOUBLE))', 'churn_rate')}, count(*) AS customers,
  CASE Tenure_Bucket WHEN '0-1y' THEN 0 WHEN '1-2y' THEN 1 WHEN '2-4y' THEN 2 WHEN '4-6y' THEN 3
                     WHEN '6-10y' THEN 4 END AS ordinal
FROM eng WHERE Tenure_Bucket IS NOT NULL GROUP BY Tenure_Bucket""", "eng")

_NUMS = ("tenure", "MonthlyCharges", "TotalCharges", "Churn_Target", "Service_Count",
         "Avg_Historical_Charge")
_corr_parts = []
for _a in _NUMS:
    for _b in _NUMS:
        _corr_parts.append(f"SELECT '{_a}' AS feature_a, '{_b}' AS feature_b, "
                           f"corr(CAST({_a} AS DOUBLE), CAST({_b} AS DOUBLE)) AS corr FROM eng")
oracle("eda_correlation", f"SELECT feature_a, feature_b, {r('corr')} FROM ("
       + " UNION ALL ".join(_corr_parts) + ")", "eng")

_DIST = ("tenure", "MonthlyCharges", "TotalCharges", "Avg_Historical_Charge")
oracle("eda_distribution", f"""
SELECT Churn_Label, feature, count(*) AS n, {r('avg(value)', 'mean')}, {r('min(value)', 'min')},
  {r('max(value)', 'max')}, {r('quantile_cont(value, 0.05)', 'p05')},
  {r('quantile_cont(value, 0.25)', 'p25')}, {r('quantile_cont(value, 0.5)', 'p50')},
  {r('quantile_cont(value, 0.75)', 'p75')}, {r('quantile_cont(value, 0.95)', 'p95')}
FROM ({_unpivot('eng', _DIST, "CASE WHEN Churn_Target = 1 THEN 'Yes' ELSE 'No' END AS Churn_Label", 'DOUBLE')})
WHERE value IS NOT NULL GROUP BY Churn_Label, feature""", "eng")

_MED = ("tenure", "MonthlyCharges", "TotalCharges", "Service_Count", "Avg_Historical_Charge")
oracle("eda_medians", "SELECT feature, " + r("median", "median") + " FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM lab WHERE NOT is_test"
    for c in _MED) + ")", "lab")

oracle("distinct_contracts", "SELECT DISTINCT Contract FROM eng", "eng")

# ---- live policy, segments, routing, queues -------------------------------------------
CRIT, TARGET, SAFE = "'🔴 Critical Risk'", "'🟡 Target Zone'", "'🟢 Safe'"

cte("results", """
SELECT l.customerID, l.tenure, l.MonthlyCharges, l.TotalCharges, l.Contract, l.PaymentMethod,
  l.InternetService, l.Tenure_Bucket, l.Service_Count, s.churn_prob AS Churn_Prob,
  l.Churn_Target AS Actual_Churn
FROM scores s JOIN lab l USING (customerID)""", ("scores", "lab"))
cte("v1seg", f"""
SELECT r.*,
  CASE WHEN Churn_Prob >= 0.85 THEN {CRIT} WHEN Churn_Prob >= b.threshold THEN {TARGET} ELSE {SAFE} END AS Segment,
  CASE WHEN Churn_Prob >= 0.85 THEN 'Call / Win-Back' WHEN Churn_Prob >= b.threshold THEN 'Send Discount'
       ELSE 'No Action' END AS Action
FROM results r, best b""", ("results", "best"))
cte("capseg", f"""
SELECT r.*,
  CASE WHEN c.customerID IS NOT NULL THEN {CRIT} WHEN Churn_Prob >= b.threshold THEN {TARGET} ELSE {SAFE} END AS Segment,
  CASE WHEN c.customerID IS NOT NULL THEN 'Call / Win-Back' WHEN Churn_Prob >= b.threshold THEN 'Send Discount'
       ELSE 'No Action' END AS Action
FROM results r CROSS JOIN best b LEFT JOIN (
  SELECT DISTINCT customerID FROM (SELECT customerID FROM results, best
    WHERE Churn_Prob >= best.threshold ORDER BY Churn_Prob DESC, customerID LIMIT 200)) c
  ON r.customerID = c.customerID""", ("results", "best"))
_COLL = ("tenure", "MonthlyCharges", "TotalCharges", "Contract", "PaymentMethod", "InternetService")
cte("merged", f"""
SELECT c.*, d.* EXCLUDE (customerID, churn_prob, {', '.join(_COLL)}), d.churn_prob AS churn_prob_v2,
  {', '.join(f'd.{x} AS {x}_v2' for x in _COLL)}
FROM capseg c LEFT JOIN decision d ON c.customerID = d.customerID""", ("capseg", "decision"))


def _live(fixed: bool, window: str, mins: str, only: bool, cap: int, name: str):
    base = "CAST(200.0 AS DOUBLE)" if fixed else "coalesce(clv, 0.0)"
    basis = "'Fixed LTV'" if fixed else "'CLV proxy'"
    cte(f"{name}_p", f"""
SELECT *, {basis} AS value_basis_live, {base} AS value_base_live,
  coalesce(risk_30d, 0.0) * {base} AS expected_loss_30d_live, CAST(50.0 AS DOUBLE) AS offer_cost_live,
  CAST(coalesce(risk_30d, 0.0) * {base} > 50.0 AS INTEGER) AS should_intervene_live,
  coalesce(risk_30d, 0.0) * {base} - 50.0 AS roi_proxy_live
FROM merged""", ("merged",))
    cte(f"{name}_q", f"""
SELECT m.*, CASE WHEN clv IS NULL THEN 'unknown' WHEN clv >= q.q2 THEN 'high' WHEN clv >= q.q1 THEN 'mid'
  ELSE 'low' END AS value_segment_live
FROM {name}_p m, (SELECT quantile_cont(clv, 0.33) AS q1, quantile_cont(clv, 0.66) AS q2 FROM {name}_p) q""",
        (f"{name}_p",))
    conds = []
    if mins == "mid":
        conds.append("value_segment_live IN ('mid', 'high')")
    elif mins == "high":
        conds.append("value_segment_live IN ('high')")
    if only:
        conds.append("should_intervene_live = 1")
    where = ("WHERE " + " AND ".join(conds)) if conds else ""
    cte(f"{name}_f", f"SELECT *, coalesce({window}, 0.0) AS routing_score_live FROM {name}_q {where}",
        (f"{name}_q",))
    cte(name, f"""
SELECT f.*, CASE WHEN c.customerID IS NOT NULL THEN {CRIT} WHEN should_intervene_live = 1 THEN {TARGET}
  ELSE {SAFE} END AS routing_tier_live
FROM {name}_f f LEFT JOIN (SELECT DISTINCT customerID FROM (SELECT customerID FROM {name}_f
  WHERE should_intervene_live = 1 ORDER BY routing_score_live DESC, customerID LIMIT {cap})) c
  ON f.customerID = c.customerID""", (f"{name}_f",))


_live(False, "risk_30d", "mid", True, 200, "live")
_live(True, "risk_60d", "all", False, 50, "livefix")

oracle("v1_segments", f"SELECT customerID, {r('Churn_Prob')}, Segment, Action FROM v1seg", "v1seg")
oracle("segment_counts", "SELECT Segment, count(*) AS count FROM v1seg GROUP BY Segment", "v1seg")
oracle("segment_profile", f"""
SELECT CASE WHEN r.Churn_Prob >= b.threshold THEN 'High Risk' ELSE 'Safe' END AS "Group",
  {r('avg(r.tenure)', 'tenure')}, {r('avg(r.MonthlyCharges)', 'MonthlyCharges')}
FROM results r, best b GROUP BY 1""", "results", "best")
oracle("action_list_v1", f"""
SELECT customerID, Segment, {r('Churn_Prob')}, Action, {r('tenure')}, {r('MonthlyCharges')}, Contract,
  PaymentMethod FROM v1seg WHERE Segment IN ({CRIT}, {TARGET}) AND Contract IN ('Month-to-month')""", "v1seg")
oracle("segment_positions", f"""
SELECT customerID, Segment, {r('MonthlyCharges')},
  row_number() OVER (PARTITION BY Segment ORDER BY MonthlyCharges ASC NULLS LAST, customerID) - 1 AS position
FROM v1seg""", "v1seg")
oracle("tenure_positions", f"""
SELECT customerID, Segment, {r('tenure')}, {r('tenure / 12.0', 'tenure_years')},
  CASE WHEN tenure < 12 THEN CAST(CAST(trunc(tenure) AS BIGINT) AS VARCHAR) || ' months'
       ELSE printf('%.1f years', round_even(tenure / 12.0, 1)) END AS tenure_display,
  row_number() OVER (PARTITION BY Segment ORDER BY tenure ASC NULLS LAST, customerID) - 1 AS position
FROM v1seg WHERE tenure IS NOT NULL""", "v1seg")
oracle("capacity_segments", f"SELECT customerID, {r('Churn_Prob')}, Segment, Action FROM capseg", "capseg")
oracle("live_view", f"""
SELECT customerID, {r('Churn_Prob')}, Segment, {r('tenure')}, {r('tenure_v2')}, {r('risk_30d')}, {r('clv')},
  value_segment, value_segment_live, value_basis_live, {r('value_base_live')},
  {r('expected_loss_30d_live')}, {r('offer_cost_live')}, should_intervene_live, {r('roi_proxy_live')},
  {r('routing_score_live')}, routing_tier_live FROM live""", "live")
oracle("live_view_fixed_ltv", f"""
SELECT customerID, value_basis_live, {r('value_base_live')}, {r('expected_loss_30d_live')},
  should_intervene_live, {r('roi_proxy_live')}, {r('routing_score_live')}, routing_tier_live
FROM livefix""", "livefix")
oracle("live_kpis", f"""
SELECT count_if(should_intervene_live = 1) AS target_customers,
  {r('coalesce(sum(expected_loss_30d_live), 0.0)', 'expected_loss_30d')},
  {r('coalesce(sum(offer_cost_live), 0.0)', 'offer_cost')},
  {r('coalesce(sum(roi_proxy_live), 0.0)', 'roi_proxy')},
  count_if(routing_tier_live = {CRIT}) AS critical_queue,
  count_if(routing_tier_live = {TARGET}) AS target_campaigns FROM live""", "live")
oracle("action_list", f"""
SELECT customerID, routing_tier_live, {r('roi_proxy_live')}, {r('roi_proxy')}, {r('risk_30d')} FROM live
ORDER BY roi_proxy_live DESC NULLS LAST, customerID LIMIT 500""", "live")
for _name, _tier in (("critical_queue", CRIT), ("target_queue", TARGET)):
    oracle(_name, f"""
SELECT customerID, {r('routing_score_live')}, {r('roi_proxy_live')} FROM live
WHERE routing_tier_live = {_tier} ORDER BY routing_score_live DESC, customerID LIMIT 200""", "live")

_live(False, "risk_30d", "mid", True, 15, "live_small")
oracle("routing_queues_limited", " UNION ALL ".join(f"""
SELECT * FROM (SELECT routing_tier_live, CAST(row_number() OVER (ORDER BY routing_score_live DESC, customerID)
  AS INTEGER) AS position, customerID, {r('routing_score_live')}, {r('roi_proxy_live')}
FROM live_small WHERE routing_tier_live = {t}) WHERE position <= 10""" for t in (CRIT, TARGET)), "live_small")
_LIST_DBL = ("Churn_Prob", "churn_prob_v2", "risk_30d", "risk_60d", "risk_90d", "tenure",
             "MonthlyCharges", "clv", "value_base_live", "expected_loss_30d_live", "offer_cost_live",
             "roi_proxy_live", "routing_score_live")
_LIST_TXT = ("customerID", "Segment", "Contract", "PaymentMethod", "value_segment",
             "value_segment_live", "value_basis_live", "should_intervene_live", "routing_tier_live",
             "reason_1", "recommended_action", "intervention_type")
oracle("action_list_limited", f"""
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY roi_proxy_live DESC NULLS LAST, customerID)
  AS INTEGER) AS position, {', '.join(_LIST_TXT)}, {', '.join(r(c) for c in _LIST_DBL)}
FROM live_small) WHERE position <= 12""", "live_small")
_OPS = "should_intervene DESC, priority_score DESC, expected_loss_30d DESC, customerID"
oracle("ops_top_limited", f"""
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY {_OPS}) AS INTEGER) AS position, customerID,
  should_intervene, {r('priority_score')}, {r('expected_loss_30d')} FROM decision) WHERE position <= 20""",
       "decision")
oracle("ops_positions", f"""
SELECT customerID, row_number() OVER (ORDER BY {_OPS}) AS position FROM decision""", "decision")
oracle("risk_positions", f"""
SELECT customerID, {r('risk_30d')}, row_number() OVER (ORDER BY risk_30d DESC, customerID) AS position
FROM scores""", "scores")
oracle("action_list_v1_positions", f"""
SELECT customerID, {r('Churn_Prob')}, row_number() OVER (ORDER BY Churn_Prob DESC, customerID) AS position
FROM v1seg WHERE Segment IN ({CRIT}, {TARGET}) AND Contract IN ('Month-to-month')""", "v1seg")

_CASE_TXT = ("customerID", "value_segment", "value_segment_live", "value_basis_live",
             "routing_tier_live", "reason_1",
             "bucket_1", "reason_2", "bucket_2", "reason_3", "bucket_3", "recommended_action",
             "intervention_type", "should_intervene_live")
_CASE_DBL = ("Churn_Prob", "churn_prob_v2", "risk_30d", "risk_60d", "risk_90d", "clv",
             "value_base_live",
             "expected_loss_30d_live", "offer_cost_live", "roi_proxy_live", "impact_1", "impact_2",
             "impact_3")
oracle("case_file", "SELECT " + ", ".join(list(_CASE_TXT) + [r(c) for c in _CASE_DBL]) + """
FROM live WHERE customerID = (SELECT customerID FROM live
  ORDER BY roi_proxy_live DESC NULLS LAST, customerID LIMIT 1)""", "live")


def _stack(src, cols, name):
    return " UNION ALL ".join(f"SELECT nullif({c}, '') AS {name} FROM {src}" for c in cols)


oracle("bucket_mix", f"""
SELECT bucket, count(*) AS count FROM ({_stack('live', ['bucket_1', 'bucket_2', 'bucket_3'], 'bucket')})
WHERE bucket IS NOT NULL GROUP BY bucket""", "live")
oracle("top_reasons", f"""
SELECT reason, count(*) AS count FROM ({_stack('live', ['reason_1', 'reason_2', 'reason_3'], 'reason')})
WHERE reason IS NOT NULL GROUP BY reason ORDER BY count DESC, reason LIMIT 15""", "live")

cte("dec_f", "SELECT * FROM decision WHERE value_segment IN ('mid', 'high') AND should_intervene = 1",
    ("decision",))
oracle("portfolio_kpis", f"""
SELECT count(*) AS customers, {r('coalesce(sum(expected_loss_30d), 0.0)', 'expected_loss_30d')},
  {r('coalesce(sum(offer_cost), 0.0)', 'offer_cost')}, {r('coalesce(sum(roi_proxy), 0.0)', 'roi_proxy')}
FROM dec_f""", "dec_f")
oracle("intervention_mix", "SELECT intervention_type, count(*) AS count FROM dec_f GROUP BY 1", "dec_f")
oracle("risk_value_points", f"""
SELECT customerID, {r('risk_30d')}, {r('clv')}, {r('expected_loss_30d')}, intervention_type, reason_1,
  recommended_action FROM dec_f
ORDER BY should_intervene DESC, priority_score DESC, expected_loss_30d DESC, customerID LIMIT 2000""", "dec_f")
oracle("risk_value_limited", f"""
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY {_OPS}) AS INTEGER) AS position, customerID,
  {r('risk_30d')}, {r('clv')}, {r('expected_loss_30d')} FROM dec_f) WHERE position <= 15""", "dec_f")
oracle("ops_top", f"""
SELECT customerID, should_intervene, {r('priority_score')}, {r('expected_loss_30d')}, value_segment,
  intervention_type FROM decision
ORDER BY should_intervene DESC, priority_score DESC, expected_loss_30d DESC, customerID LIMIT 300""", "decision")
oracle("risk_sorted", f"""
SELECT customerID, {r('s.risk_30d', 'risk_30d')}, reason_1, recommended_action
FROM rc JOIN scores s USING (customerID)""", "rc", "scores")
oracle("key_profile", """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, count_if(n > 1) AS duplicate_keys
FROM (SELECT customerID, count(*) AS n FROM decision GROUP BY customerID)""", "decision")
oracle("clv_quantiles", f"""
SELECT {r('quantile_cont(clv, 0.33)', 'q1')}, {r('quantile_cont(clv, 0.66)', 'q2')} FROM merged""", "merged")

# ---- sources and sinks ------------------------------------------------------------------
ORACLE["csv_roundtrip_engineered"] = ORACLE["engineered_v2"].replace(
    "round(days_to_churn, 6) AS days_to_churn, ", "")
ORACLE["metrics_json_roundtrip"] = ORACLE["model_metrics"]
ORACLE["threshold_report_table"] = ORACLE["threshold_report"]
ORACLE["export_filtered_list"] = ORACLE["action_list_v1"]
oracle("ensure_decision_table", f"""
SELECT customerID, {r('clv')}, intervention_type, should_intervene FROM decision""", "decision")

_MODEL_IN = ("customerID", "tenure", "MonthlyCharges", "TotalCharges", "InternetService",
             "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
             "TechSupport", "StreamingTV", "StreamingMovies", "Partner", "Dependents", "Contract",
             "PaymentMethod", "Tenure_Bucket", "Service_Count", "Avg_Historical_Charge",
             "Payment_Simple")
oracle("model_inputs", f"SELECT {_proj(_MODEL_IN, _ENG_DOUBLES)} FROM lab", "lab")
oracle("carry_forward_context", f"""
SELECT rc.customerID, {r('rc.churn_prob', 'churn_prob')}, reason_1, {r('impact_1')}, reason_2,
  {r('impact_2')}, reason_3, {r('impact_3')}, bucket_1, bucket_2, bucket_3, recommended_action,
  {r('l.tenure', 'tenure')}, {r('l.MonthlyCharges', 'MonthlyCharges')},
  {r('l.TotalCharges', 'TotalCharges')}, l.Contract, l.PaymentMethod, l.InternetService
FROM rc LEFT JOIN lab l USING (customerID)""", "rc", "lab")
oracle("high_risk_drilldown", f"""
SELECT r.customerID, {r('r.Churn_Prob', 'Churn_Prob')} FROM results r, best b
WHERE r.Churn_Prob > b.threshold""", "results", "best")
ORACLE["metrics_json_document"] = ORACLE["model_metrics"]

oracle("scores_all", f"""
SELECT customerID, {r('churn_prob')}, {r('risk_30d')}, {r('risk_60d')}, {r('risk_90d')} FROM scores_all""",
       "scores_all")
oracle("decision_table_all",
       "SELECT " + ", ".join(list(_DEC_OTHER) + [r(c) for c in _DEC_DOUBLES]) + " FROM decision_all",
       "decision_all")

# G1 exact-count stratified split: allocation as in operators/split.class_allocation
cte("sx_c", "SELECT Churn_Target, count(*) AS k FROM eng GROUP BY Churn_Target", ("eng",))
cte("sx_t", "SELECT *, sum(k) OVER () AS n, CAST(ceil(0.2 * sum(k) OVER ()) AS BIGINT) AS n_test FROM sx_c",
    ("sx_c",))
cte("sx_f", "SELECT *, n_test * k / n AS share, CAST(floor(n_test * k / n) AS BIGINT) AS base FROM sx_t",
    ("sx_t",))
cte("sx_r", """
SELECT *, row_number() OVER (ORDER BY share - base DESC, k DESC, Churn_Target) AS rk,
  n_test - sum(base) OVER () AS lft FROM sx_f""", ("sx_f",))
cte("sx_a", "SELECT Churn_Target, base + CASE WHEN rk <= lft THEN 1 ELSE 0 END AS alloc FROM sx_r",
    ("sx_r",))
cte("sx_p", """
SELECT Churn_Target, row_number() OVER (PARTITION BY Churn_Target
  ORDER BY ('0x' || substr(md5('42-' || customerID), 1, 8))::BIGINT / 4294967296.0, customerID) - 1 AS pos
FROM eng""", ("eng",))
oracle("split_exact", """
SELECT p.pos < a.alloc AS is_test, p.Churn_Target, count(*) AS customers
FROM sx_p p JOIN sx_a a USING (Churn_Target) GROUP BY 1, 2""", "sx_p", "sx_a")

oracle("top_drivers", f"""
SELECT fname AS feature,
  {r('sum(abs(c_c)) / (SELECT count(*) FROM scores)', 'mean_abs_contribution')}
FROM contrib WHERE is_test GROUP BY fname
ORDER BY sum(abs(c_c)) / (SELECT count(*) FROM scores) DESC, fname LIMIT 20""", "contrib", "scores")

_RULE_NAMES = (
    "cat__Contract_Month-to-month", "cat__Contract_Two year", "cat__PaymentMethod_Electronic check",
    "cat__PaymentMethod_Mailed check", "num__MonthlyCharges", "num__TotalCharges",
    "num__Avg_Historical_Charge", "cat__TechSupport_No", "cat__TechSupport_Yes",
    "cat__OnlineSecurity_No", "cat__DeviceProtection_Yes", "cat__InternetService_Fiber optic",
    "cat__StreamingTV_Yes", "num__tenure", "cat__Tenure_Bucket_0-1y", "cat__MultipleLines_Yes",
    "cat__Partner_Yes", "num__Service_Count", "",
)
oracle("rule_chains", f"""
SELECT *, {M.cost('offer')} AS offer_cost
FROM (SELECT *, {M.offer('action', 'value_segment')} AS offer
FROM (SELECT *, {M.bucket('reason')} AS bucket, {M.action(['reason'])} AS action
FROM (SELECT *, {M.clean_name('name')} AS reason
FROM (SELECT CAST(c_custkey AS VARCHAR) AS customerID,
  list_extract([{', '.join(map(M.q, _RULE_NAMES))}], CAST(c_custkey % 19 AS INTEGER) + 1) AS name,
  list_extract(['low', 'mid', 'high'], CAST((c_custkey // 19) % 3 AS INTEGER) + 1) AS value_segment
FROM customer))))""")

# ---- quarantine, odd numbers, null labels, the fit matrix, model invariants --------------
oracle("csv_quarantine", """
SELECT count(*) AS engineered, count(customerID) AS with_key,
  count_if(CAST(customerID AS BIGINT) % 10 = 0) AS quarantined,
  min(CASE WHEN CAST(customerID AS BIGINT) % 10 = 0 THEN customerID || ',cut short' END) AS first_line,
  count(*) AS rows_seen, count_if(CAST(customerID AS BIGINT) % 10 = 0) AS malformed_seen
FROM subscribers""", "subscribers")
oracle("odd_charges", f"""
SELECT customerID, {r('charge', 'TotalCharges')},
  {r('charge / (coalesce(tenure, 0.0) + 1)', 'Avg_Historical_Charge')}
FROM (SELECT *, CASE WHEN CAST(customerID AS BIGINT) % 3 = 2 THEN TotalCharges END AS charge FROM eng)""", "eng")
cte("nl_rows", """
SELECT customerID, CASE WHEN CAST(customerID AS BIGINT) % 7 <> 0 THEN Churn_Target END AS label,
    CAST('0x' || substr(md5('42-' || customerID), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM eng""", ("eng",))
cte("nl_share", """
SELECT label, count(*) AS n, ceil(0.2 * sum(count(*)) OVER ()) * count(*)
    / sum(count(*)) OVER () AS share, ceil(0.2 * sum(count(*)) OVER ()) AS n_test FROM nl_rows GROUP BY label""", ("nl_rows",))
cte("nl_take", """
SELECT label, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, n DESC,
    label NULLS LAST) <= n_test - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS take FROM nl_share""", ("nl_share",))
oracle("split_exact_null_labels", """
SELECT pos <= take AS is_test, p.label, count(*) AS customers
FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY u, customerID) AS pos FROM nl_rows) p
JOIN nl_take a ON p.label IS NOT DISTINCT FROM a.label GROUP BY 1, 2""", "nl_rows", "nl_take")

_MODEL_NUM = ("tenure", "MonthlyCharges", "TotalCharges", "Service_Count", "Avg_Historical_Charge")
_MODEL_CAT = ("InternetService", "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup",
              "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Partner", "Dependents",
              "Contract", "PaymentMethod", "Tenure_Bucket", "Payment_Simple")
cte("m_num", " UNION ALL ".join(
    f"SELECT customerID, is_test, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM lab" for c in _MODEL_NUM), ("lab",))
cte("m_cat", " UNION ALL ".join(
    f"SELECT customerID, is_test, '{c}' AS name, coalesce({c}, 'nan') AS v FROM lab" for c in _MODEL_CAT), ("lab",))
cte("m_plan", """
SELECT name, quantile_cont(v, 0.5) AS fill, list_distinct(list_transform(range(1, 64), lambda i:
  list_extract(list(v ORDER BY v), CAST(floor((count(v) - 1) * (i / 64.0)) AS BIGINT) + 1))) AS cuts
FROM m_num WHERE NOT is_test AND v IS NOT NULL GROUP BY name""", ("m_num",))
oracle("model_inputs_plan", f"""
SELECT name, 'numeric' AS kind, {r('fill')}, CAST(len(cuts) AS INTEGER) AS n_cuts, CAST(NULL AS INTEGER) AS n_values
FROM m_plan UNION ALL
SELECT name, 'dictionary', NULL, NULL, CAST(count(DISTINCT v) AS INTEGER) FROM m_cat WHERE NOT is_test GROUP BY name""",
       "m_plan", "m_cat")
oracle("model_matrix", """
SELECT customerID, 'num__' || name AS feature, CAST(len(list_filter(cuts, lambda c: c < coalesce(v, fill))) AS INTEGER)
  AS value FROM m_num JOIN m_plan USING (name)
UNION ALL
SELECT customerID, 'cat__' || name || '_' || v, CAST(1 AS INTEGER) FROM m_cat
WHERE (name, v) IN (SELECT (name, v) FROM m_cat WHERE NOT is_test)""", "m_num", "m_plan", "m_cat")
oracle("gbt_model_checks", " UNION ALL ".join(
    f"SELECT '{c}' AS label, count(*) AS rows, count(*) AS in_unit, count(*) AS same_from_leaves, "
    f"count(*) AS same_from_folder FROM lab WHERE is_test" for c in ("Churn_Target", "y_30d", "y_60d", "y_90d")),
    "lab")
oracle("gbt_shapley_checks", "SELECT count(*) AS rows, count(*) AS additive FROM lab WHERE is_test", "lab")
