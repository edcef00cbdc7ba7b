"""Oracle fragments: split, window labels, scorecard, scores, reason codes,
decision table."""

from collections import namedtuple

from . import cte

# ---- fixed values, spelled out here so that the gate can notice a typo in the library ----
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
OFFER_COSTS = {
    "discount_offer": 40.0,
    "contract_incentive": 60.0,
    "support_intervention": 15.0,
    "service_quality_check": 10.0,
    "autopay_nudge": 5.0,
}
Feature = namedtuple("Feature", "name kind width", defaults=("cat", 1.0))
FEATURES = (
    Feature("InternetService"), Feature("PhoneService"), Feature("MultipleLines"),
    Feature("OnlineSecurity"), Feature("OnlineBackup"), Feature("DeviceProtection"),
    Feature("TechSupport"), Feature("StreamingTV"), Feature("StreamingMovies"), Feature("Partner"),
    Feature("Dependents"), Feature("Contract"), Feature("PaymentMethod"), Feature("Tenure_Bucket"),
    Feature("Payment_Simple"),
    Feature("tenure", "num", 12.0), Feature("MonthlyCharges", "num", 20.0),
    Feature("TotalCharges", "num", 500.0), Feature("Service_Count", "num", 1.0),
    Feature("Avg_Historical_Charge", "num", 20.0),
)
# -----------------------------------------------------------------------------------------

LABELS = (("c", "Churn_Target"), ("30", "y_30d"), ("60", "y_60d"), ("90", "y_90d"))
RISK = {"c": "churn_prob", "30": "risk_30d", "60": "risk_60d", "90": "risk_90d"}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


cte("lab", """
SELECT *,
  CAST(coalesce(days_to_churn <= 30, false) AS INTEGER) AS y_30d,
  CAST(coalesce(days_to_churn <= 60, false) AS INTEGER) AS y_60d,
  CAST(coalesce(days_to_churn <= 90, false) AS INTEGER) AS y_90d,
  (('0x' || substr(md5('42-' || customerID), 1, 8))::BIGINT / 4294967296.0) < 0.2 AS is_test
FROM eng""", ("eng",))


def _value(f) -> str:
    if f.kind == "num":
        return (f"coalesce(CAST(CAST(floor({f.name} / {float(f.width)}) AS BIGINT) AS VARCHAR), 'nan')")
    return f"coalesce(CAST({f.name} AS VARCHAR), 'nan')"


def _fname(f, value_sql: str) -> str:
    if f.kind == "num":
        return q(f"num__{f.name}")
    return f"'cat__{f.name}_' || {value_sql}"


_feat_parts = []
for i, f in enumerate(FEATURES):
    v = _value(f)
    _feat_parts.append(
        f"SELECT customerID, is_test, Churn_Target, y_30d, y_60d, y_90d, {i} AS fpos, "
        f"{q(f.name)} AS feature, {v} AS value, {_fname(f, v)} AS fname FROM lab")
cte("feat", "\nUNION ALL\n".join(_feat_parts), ("lab",))

_sums = ", ".join(f"CAST(sum({lab}) AS DOUBLE) AS pos_{k}" for k, lab in LABELS)
cte("fit", f"""
SELECT feature, value, CAST(count(*) AS DOUBLE) AS n, {_sums}
FROM feat WHERE NOT is_test GROUP BY feature, value""", ("feat",))

_tot = ", ".join(f"sum(pos_{k}) OVER (PARTITION BY feature) AS P_{k}" for k, _ in LABELS)
cte("fit_t", f"SELECT *, sum(n) OVER (PARTITION BY feature) AS nt, {_tot} FROM fit", ("fit",))
_woe = ", ".join(
    f"ln((pos_{k} + 0.5) / (P_{k} + 1.0)) - ln((n - pos_{k} + 0.5) / (nt - P_{k} + 1.0)) AS woe_{k}"
    for k, _ in LABELS)
cte("woe", f"SELECT *, {_woe} FROM fit_t", ("fit_t",))
_mean = ", ".join(f"sum(n * woe_{k}) OVER (PARTITION BY feature) / nt AS mean_{k}" for k, _ in LABELS)
cte("woe_m", f"SELECT *, {_mean} FROM woe", ("woe",))
_c = ", ".join(f"woe_{k} - mean_{k} AS c_{k}" for k, _ in LABELS)
cte("model", f"SELECT *, {_c} FROM woe_m", ("woe_m",))
_fm = ", ".join(f"max(mean_{k}) AS mean_{k}" for k, _ in LABELS)
cte("fmeans", f"SELECT feature, max(nt) AS nt, {', '.join(f'max(P_{k}) AS P_{k}' for k, _ in LABELS)}, {_fm} "
              f"FROM model GROUP BY feature", ("model",))
_base = ", ".join(
    f"ln((max(P_{k}) + 0.5) / (max(nt) - max(P_{k}) + 0.5)) + sum(mean_{k}) AS base_{k}"
    for k, _ in LABELS)
cte("base", f"SELECT {_base} FROM fmeans", ("fmeans",))

_cc = ", ".join(f"coalesce(m.c_{k}, -fm.mean_{k}) AS c_{k}" for k, _ in LABELS)
cte("contrib", f"""
SELECT f.customerID, f.is_test, f.fpos, f.feature, f.fname, {_cc}
FROM feat f JOIN fmeans fm ON f.feature = fm.feature
LEFT JOIN model m ON f.feature = m.feature AND f.value = m.value""", ("feat", "fmeans", "model"))

# margin = ((base + c_0) + c_1) + ... in feature order, as the Spark side adds
_probs = ", ".join(
    f"1.0 / (1.0 + exp(-list_reduce(list_prepend(max(b.base_{k}), list(c.c_{k} ORDER BY c.fpos)), "
    f"lambda x, y: x + y))) AS {RISK[k]}" for k, _ in LABELS)

# ---- reason codes --------------------------------------------------------------

def clean_name(x: str) -> str:
    n = f"trim(replace(replace({x}, 'num__', ''), 'cat__', ''))"
    names = ", ".join(q(s) for s in NO_SPLIT_NAMES)
    return (f"CASE WHEN {n} IN ({names}) THEN {n} "
            f"WHEN strpos({n}, '_') > 0 THEN trim(split_part({n}, '_', 1) || ' = ' || "
            f"substr({n}, strpos({n}, '_') + 1)) ELSE {n} END")


def bucket(x: str) -> str:
    whens = " ".join(f"WHEN contains({x}, {q(k)}) THEN {q(b)}" for k, b in BUCKET_RULES)
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN '' {whens} ELSE {q(OTHER_BUCKET)} END"


def action_match(x: str) -> str:
    whens = " ".join(f"WHEN contains({x}, {q(k)}) THEN {q(a)}" for k, a in ACTION_RULES)
    return f"CASE {whens} END"


def action(rs) -> str:
    return "coalesce(" + ", ".join(action_match(r) for r in rs) + f", {q(DEFAULT_ACTION)})"


_rc = ", ".join(
    f"coalesce(max(CASE WHEN rk = {i} THEN {clean_name('fname')} END), '') AS reason_{i}, "
    f"coalesce(max(CASE WHEN rk = {i} THEN c_c END), 0.0) AS impact_{i}" for i in (1, 2, 3))

# ---- decision table ---------------------------------------------------------------


def offer(action_sql: str, seg_sql: str) -> str:
    a = f"lower(coalesce({action_sql}, ''))"
    whens = []
    for keys, name in OFFER_RULES:
        cond = " OR ".join(f"contains({a}, {q(k)})" for k in keys)
        whens.append(f"WHEN {cond} THEN {q(name)}")
    o = f"(CASE {' '.join(whens)} ELSE {q(DEFAULT_OFFER)} END)"
    gated = ", ".join(q(x) for x in LOW_VALUE_GATED)
    return (f"CASE WHEN coalesce({seg_sql}, 'mid') = 'low' AND {o} IN ({gated}) "
            f"THEN {q(LOW_VALUE_OFFER)} ELSE {o} END")


def cost(x: str, costs=OFFER_COSTS) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN CAST({float(v)} AS DOUBLE)" for k, v in costs.items())
    return f"CASE {x} {whens} ELSE CAST(0.0 AS DOUBLE) END"


def scoring_chain(sfx: str, rows: str) -> None:
    """scores / reason codes / decision table over the rows selected by
    `rows` (the hold-out: is_test; everyone: TRUE); CTE names end in sfx."""
    cte(f"scores{sfx}", f"""
SELECT c.customerID, {_probs}
FROM contrib c, base b WHERE {rows} GROUP BY c.customerID""", ("contrib", "base"))
    cte(f"rc_rank{sfx}", f"""
SELECT customerID, fname, c_c,
  row_number() OVER (PARTITION BY customerID
                     ORDER BY CASE WHEN haspos THEN -c_c ELSE -abs(c_c) END, fname) AS rk
FROM (SELECT customerID, fname, c_c, max(c_c > 0) OVER (PARTITION BY customerID) AS haspos
      FROM contrib c WHERE {rows})
WHERE (NOT haspos) OR c_c > 0""", ("contrib",))
    cte(f"rc0{sfx}", f"SELECT customerID, {_rc} FROM rc_rank{sfx} GROUP BY customerID",
        (f"rc_rank{sfx}",))
    cte(f"rc{sfx}", f"""
SELECT r.*, s.churn_prob, {bucket('reason_1')} AS bucket_1, {bucket('reason_2')} AS bucket_2,
  {bucket('reason_3')} AS bucket_3, {action(['reason_1', 'reason_2', 'reason_3'])} AS recommended_action
FROM rc0{sfx} r JOIN scores{sfx} s USING (customerID)""", (f"rc0{sfx}", f"scores{sfx}"))
    cte(f"dt0{sfx}", f"""
SELECT rc.*, s.risk_30d, s.risk_60d, s.risk_90d,
  coalesce(l.tenure, 0.0) AS tenure, coalesce(l.MonthlyCharges, 0.0) AS MonthlyCharges,
  l.TotalCharges, l.Contract, l.PaymentMethod, l.InternetService,
  coalesce(l.MonthlyCharges, 0.0) * 0.6 AS monthly_margin,
  coalesce(l.tenure, 0.0) + 12 AS remaining_months_proxy,
  coalesce(l.MonthlyCharges, 0.0) * 0.6 * (coalesce(l.tenure, 0.0) + 12) AS clv
FROM rc{sfx} rc JOIN scores{sfx} s USING (customerID) JOIN lab l USING (customerID)""",
        (f"rc{sfx}", f"scores{sfx}", "lab"))
    cte(f"dt1{sfx}", f"""
SELECT *,
  CASE WHEN clv >= 1000.0 THEN 'high' WHEN clv >= 400.0 THEN 'mid' ELSE 'low' END AS value_segment,
  risk_30d * clv AS expected_loss_30d, risk_60d * clv AS expected_loss_60d,
  risk_90d * clv AS expected_loss_90d,
  0.6 * risk_30d + 0.3 * risk_60d + 0.1 * risk_90d AS priority_score
FROM dt0{sfx}""", (f"dt0{sfx}",))
    cte(f"dt2{sfx}", f"SELECT *, {offer('recommended_action', 'value_segment')} AS intervention_type "
        f"FROM dt1{sfx}", (f"dt1{sfx}",))
    cte(f"dt3{sfx}", f"SELECT *, {cost('intervention_type')} AS offer_cost FROM dt2{sfx}", (f"dt2{sfx}",))
    cte(f"decision{sfx}", f"""
SELECT *, CAST(coalesce(expected_loss_30d > offer_cost, false) AS INTEGER) AS should_intervene,
  expected_loss_30d - offer_cost AS roi_proxy
FROM dt3{sfx}""", (f"dt3{sfx}",))


scoring_chain("", "c.is_test")
scoring_chain("_all", "TRUE")
