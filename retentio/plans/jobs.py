"""Composed jobs: labelled table, model fit, scored hold-out, reason codes,
decision table (H9/H10). Each returns a lazy DataFrame except the model
fit, which runs one aggregation and keeps the small model table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RISK_WINDOWS, RetentionPolicy
from ..functions import rules as R
from ..operators import explain as X
from ..operators import features as B
from ..operators import labels as L
from ..operators import split as S
from ..operators import value as V
from ..operators.scorecard import Scorecard, fit_scorecard

CHURN_LABEL = "Churn_Target"
WINDOW_LABELS = tuple(f"y_{w}d" for w in RISK_WINDOWS)
SCORE_COLUMNS = {CHURN_LABEL: "churn_prob", **{f"y_{w}d": f"risk_{w}d" for w in RISK_WINDOWS}}
CONTEXT_COLUMNS = ("tenure", "MonthlyCharges", "TotalCharges", "Contract", "PaymentMethod",
                   "InternetService")


def labeled(raw: DataFrame, profile: str = "v2", test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Engineered table + window labels + the shared id-based split flag
    (one split for every model: no leakage between churn and timing models)."""
    eng = B.normalize_keys(B.engineered(raw, profile))          # B16 at ingest
    if "days_to_churn" in eng.columns:
        eng = L.make_window_labels(eng)
    return S.with_split(eng, "customerID", test_size, seed)


def fit_models(lab: DataFrame, features=None) -> Scorecard:
    """Churn model and the three horizon models in one aggregation pass."""
    labels = [CHURN_LABEL] + [l for l in WINDOW_LABELS if l in lab.columns]
    return fit_scorecard(lab.filter(~F.col("is_test")), labels, features)


def scored(lab: DataFrame, model: Scorecard, test_only: bool = True,
           contributions: bool = True) -> DataFrame:
    rows = lab.filter(F.col("is_test")) if test_only else lab
    outputs = {l: SCORE_COLUMNS[l] for l in model.labels}
    return model.transform(rows, outputs, "contribs" if contributions else None, CHURN_LABEL)


def reason_code_table(sc: DataFrame, k: int = 3) -> DataFrame:
    """reason_codes_test: customerID, churn_prob, reason/impact 1..k,
    bucket 1..k, recommended_action."""
    rc = X.add_reason_codes(sc.select("customerID", "churn_prob", "contribs"), "contribs", k)
    return X.add_buckets_and_actions(rc, k)


def decision_table(sc: DataFrame, policy: RetentionPolicy = RetentionPolicy(),
                   k: int = 3, exact_rules: bool = False) -> DataFrame:
    """H9: reason codes + horizon risks + context + CLV + segment +
    expected loss + priority + intervention + cost + flag + ROI.
    All columns of one row come from that row: one narrow stage after
    scoring (no join, no shuffle)."""
    keep = ["customerID", "churn_prob", "contribs"]
    keep += [c for c in ("risk_30d", "risk_60d", "risk_90d") if c in sc.columns]
    keep += [c for c in CONTEXT_COLUMNS if c in sc.columns]
    out = X.add_reason_codes(sc.select(*keep), "contribs", k)
    out = X.add_buckets_and_actions(out, k, exact_rules)
    out = V.add_clv(out, policy.margin_rate, policy.expected_future_months)
    out = V.add_value_segment(out, policy.high_value_clv, policy.mid_value_clv)
    out = add_expected_loss(out)
    out = add_priority(out, policy.w30, policy.w60, policy.w90)
    return add_intervention_and_roi(out, policy.costs)


def decision_table_v1(sc: DataFrame, k: int = 3) -> DataFrame:
    """The earlier table without valuation (reason codes + risks)."""
    keep = ["customerID", "churn_prob", "contribs"]
    keep += [c for c in ("risk_30d", "risk_60d", "risk_90d") if c in sc.columns]
    out = X.add_reason_codes(sc.select(*keep), "contribs", k)
    return X.add_buckets_and_actions(out, k)


def add_expected_loss(df: DataFrame, windows=RISK_WINDOWS) -> DataFrame:
    """H4."""
    return df.withColumns({f"expected_loss_{w}d": F.col(f"risk_{w}d") * F.col("clv")
                           for w in windows if f"risk_{w}d" in df.columns})


def add_priority(df: DataFrame, w30: float, w60: float, w90: float) -> DataFrame:
    """H5; without horizon risks there is no priority."""
    if not all(f"risk_{w}d" in df.columns for w in RISK_WINDOWS):
        return df
    return df.withColumn("priority_score", F.lit(w30) * F.col("risk_30d")
                         + F.lit(w60) * F.col("risk_60d") + F.lit(w90) * F.col("risk_90d"))


def add_intervention_and_roi(df: DataFrame, costs: dict) -> DataFrame:
    """H6-H8."""
    seg = F.col("value_segment") if "value_segment" in df.columns else F.lit("mid")
    act = F.col("recommended_action") if "recommended_action" in df.columns else F.lit("")
    out = df.withColumn("intervention_type", R.choose_intervention(act, seg))
    out = out.withColumn("offer_cost", R.offer_cost(F.col("intervention_type"), costs))
    if "expected_loss_30d" not in out.columns:
        return out
    loss, cost = F.col("expected_loss_30d"), F.col("offer_cost")
    return out.withColumns({
        "should_intervene": F.coalesce((loss > cost).cast("int"), F.lit(0)),
        "roi_proxy": loss - cost,
    })


def ops_order(df: DataFrame) -> list:
    """E1 sort keys (+ customerID so ties are deterministic)."""
    return [F.col("should_intervene").desc(), F.col("priority_score").desc(),
            F.col("expected_loss_30d").desc(), F.col("customerID").asc()]
