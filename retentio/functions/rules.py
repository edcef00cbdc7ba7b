"""Ordered rule chains as column expressions.

Each ordered (substring -> label) list becomes one CASE chain evaluated
inside the JVM; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: reason display, bucket and action rules ----------------
NO_SPLIT_NAMES = ("Avg_Historical_Charge", "Service_Count", "TotalCharges", "MonthlyCharges")

BUCKET_RULES = (
    ("Contract", "Contract & Commitment"),
    ("PaymentMethod", "Billing & Payments"),
    ("MonthlyCharges", "Pricing"),
    ("TotalCharges", "Pricing"),
    ("Avg_Historical_Charge", "Pricing"),
    ("TechSupport", "Support Experience"),
    ("OnlineSecurity", "Product Value"),
    ("DeviceProtection", "Product Value"),
    ("InternetService", "Product Value"),
    ("Streaming", "Product Usage"),
    ("tenure", "Tenure & Lifecycle"),
    ("Tenure", "Tenure & Lifecycle"),
    ("MultipleLines", "Plan Structure"),
)
OTHER_BUCKET = "Other"

ACTION_RULES = (
    ("Contract = Month-to-month", "Offer 12-month contract incentive"),
    ("PaymentMethod = Electronic check", "Nudge to autopay + small credit"),
    ("InternetService = Fiber optic", "Proactive service quality check"),
    ("TechSupport = No", "Offer support onboarding / free month support"),
    ("OnlineSecurity = No", "Bundle security add-on trial"),
    ("MonthlyCharges", "Offer targeted discount / plan optimization"),
    ("TotalCharges", "Offer plan reprice / discount review"),
    ("tenure", "New customer onboarding campaign"),
)
DEFAULT_ACTION = "Review account for retention offer"

# recommended action (lower-cased substring) -> offer type, first hit wins
OFFER_RULES = (
    (("contract",), "contract_incentive"),
    (("autopay",), "autopay_nudge"),
    (("support",), "support_intervention"),
    (("service", "quality"), "service_quality_check"),
)
DEFAULT_OFFER = "discount_offer"
LOW_VALUE_GATED = ("contract_incentive", "discount_offer")
LOW_VALUE_OFFER = "support_intervention"

SEGMENT_CRITICAL = "🔴 Critical Risk"
SEGMENT_TARGET = "🟡 Target Zone"
SEGMENT_SAFE = "🟢 Safe"
ACTION_CALL = "Call / Win-Back"
ACTION_DISCOUNT = "Send Discount"
ACTION_NONE = "No Action"
# ---------------------------------------------------------------------------


def clean_feature_name(name: Column) -> Column:
    """Strip encoder prefixes; protected names stay whole; otherwise
    split once at the first '_' into 'left = right'."""
    n = F.trim(F.replace(F.replace(name, F.lit("num__"), F.lit("")),
                         F.lit("cat__"), F.lit("")))
    pos = F.instr(n, "_")
    split = F.trim(F.concat(F.substring_index(n, "_", 1), F.lit(" = "),
                            n.substr(pos + 1, F.lit(1 << 30))))
    return (F.when(n.isin(*NO_SPLIT_NAMES), n)
            .when(pos > 0, split)
            .otherwise(n))


def bucket_reason(reason: Column) -> Column:
    """First matching substring rule; '' stays ''; else Other."""
    expr = F.when(reason.isNull() | (F.trim(reason) == ""), F.lit(""))
    for key, bucket in BUCKET_RULES:
        expr = expr.when(reason.contains(key), F.lit(bucket))
    return expr.otherwise(F.lit(OTHER_BUCKET))


def _action_match(reason: Column, exact: bool = False) -> Column:
    """First action rule whose key occurs in the reason; NULL when none."""
    expr = None
    for key, action in ACTION_RULES:
        cond = (reason == key) if (exact and " = " in key) else reason.contains(key)
        expr = F.when(cond, F.lit(action)) if expr is None else expr.when(cond, F.lit(action))
    return expr


def recommend_action(reasons: list[Column], exact: bool = False) -> Column:
    """For reasons in order, for rules in order, first hit; else default.
    `exact=True` matches 'key = value' rules on the whole reason (so that
    'TechSupport = No' no longer matches 'TechSupport = No internet service')."""
    return F.coalesce(*[_action_match(r, exact) for r in reasons], F.lit(DEFAULT_ACTION))


def choose_intervention(action: Column, segment: Column) -> Column:
    """H6: offer type from the lower-cased action, then the low-value gate."""
    a = F.lower(F.coalesce(action.cast("string"), F.lit("")))
    offer = None
    for keys, name in OFFER_RULES:
        cond = None
        for k in keys:
            c = a.contains(k)
            cond = c if cond is None else (cond | c)
        offer = F.when(cond, F.lit(name)) if offer is None else offer.when(cond, F.lit(name))
    offer = offer.otherwise(F.lit(DEFAULT_OFFER))
    seg = F.coalesce(segment.cast("string"), F.lit("mid"))
    return F.when((seg == "low") & offer.isin(*LOW_VALUE_GATED), F.lit(LOW_VALUE_OFFER)).otherwise(offer)


def offer_cost(offer: Column, costs: dict) -> Column:
    """H7/C4: cost by offer type from a literal map; unknown -> 0."""
    kv = []
    for k, v in costs.items():
        kv += [F.lit(k), F.lit(float(v))]
    m = F.create_map(*kv)
    return F.coalesce(F.try_element_at(m, offer), F.lit(0.0))


def v1_segment(p: Column, threshold) -> tuple[Column, Column]:
    """Critical first (p >= .85) even when the threshold is above it."""
    from ..config import CRITICAL_PROB
    seg = (F.when(p >= CRITICAL_PROB, SEGMENT_CRITICAL).when(p >= threshold, SEGMENT_TARGET)
           .otherwise(SEGMENT_SAFE))
    act = (F.when(p >= CRITICAL_PROB, ACTION_CALL).when(p >= threshold, ACTION_DISCOUNT)
           .otherwise(ACTION_NONE))
    return seg, act
