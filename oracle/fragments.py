"""Shared CTE fragments (DuckDB dialect)."""

from . import cte

CUT = "DATE '2000-08-01'"

cte("ord", f"""
SELECT o_custkey AS c_custkey,
       min(CASE WHEN CAST(o_orderdate AS DATE) < {CUT} THEN CAST(o_orderdate AS DATE) END) AS first_before,
       max(CAST(o_orderdate AS DATE)) AS last_order,
       max(CASE WHEN CAST(o_orderdate AS DATE) >= {CUT} THEN 1 ELSE 0 END) AS has_after
FROM orders GROUP BY o_custkey""")

cte("cust", f"""
SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       o.first_before, o.last_order, o.has_after,
       date_diff('day', o.first_before, {CUT}) // 30 AS months
FROM customer c LEFT JOIN ord o ON c.c_custkey = o.c_custkey""", ("ord",))


def _flag(name, p, k):
    return f"CASE WHEN c_custkey % {p} < {k} THEN 'Yes' ELSE 'No' END AS {name}"


_FLAGS = ",\n  ".join(_flag(*r) for r in (
    ("MultipleLines", 2, 1), ("OnlineSecurity", 3, 1), ("OnlineBackup", 5, 2),
    ("DeviceProtection", 7, 3), ("TechSupport", 11, 4), ("StreamingTV", 13, 6),
    ("StreamingMovies", 17, 8), ("Partner", 19, 9), ("Dependents", 23, 7)))

cte("subscribers", f"""
SELECT CAST(c_custkey AS VARCHAR) AS customerID,
  CASE WHEN months IS NULL THEN NULL WHEN c_custkey % 101 = 0 THEN -1.0
       WHEN c_custkey % 103 = 0 THEN 130.0 ELSE CAST(months AS DOUBLE) END AS tenure,
  c_acctbal / 100 AS MonthlyCharges,
  CASE WHEN c_custkey % 97 = 0 OR months IS NULL THEN ' '
       ELSE CAST(CAST(floor(c_acctbal / 100 * months) AS BIGINT) AS VARCHAR) END AS TotalCharges,
  CASE c_nationkey % 3 WHEN 0 THEN 'No' WHEN 1 THEN 'DSL' ELSE 'Fiber optic' END AS InternetService,
  CASE WHEN c_nationkey % 5 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
  {_FLAGS},
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 'Month-to-month'
       WHEN c_mktsegment = 'FURNITURE' THEN 'One year' ELSE 'Two year' END AS Contract,
  CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE
    CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END END AS PaymentMethod,
  CASE WHEN coalesce(has_after, 0) = 0 THEN 'Yes' ELSE 'No' END AS Churn,
  CASE WHEN coalesce(has_after, 0) = 0 THEN CAST(least(greatest(
       date_diff('day', {CUT}, CAST(last_order + INTERVAL 180 DAY AS DATE)), 0), 365) AS DOUBLE)
       END AS days_to_churn
FROM cust""", ("cust",))

_NET = ("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
        "StreamingTV", "StreamingMovies")
_REPAIR = ",\n  ".join(
    f"CASE WHEN InternetService = 'No' THEN 'No internet service' ELSE {c} END AS {c}"
    for c in _NET)


def _eng0(tenure_rule_v1: bool, churn_v1: bool) -> str:
    churn = ("CAST(coalesce(Churn = 'Yes', false) AS INTEGER)" if churn_v1
             else "CAST(coalesce(lower(Churn) = 'yes', false) AS INTEGER)")
    return f"""
SELECT customerID,
  CASE WHEN tenure >= 0 AND tenure <= 120 THEN tenure END AS tenure,
  CASE WHEN MonthlyCharges >= 0 THEN MonthlyCharges END AS MonthlyCharges,
  TRY_CAST(TotalCharges AS DOUBLE) AS TotalCharges,
  InternetService, PhoneService,
  CASE WHEN PhoneService = 'No' THEN 'No phone service' ELSE MultipleLines END AS MultipleLines,
  {_REPAIR},
  Partner, Dependents, Contract, PaymentMethod, Churn, days_to_churn,
  {churn} AS Churn_Target
FROM subscribers"""


_COUNT = " + ".join(f"CAST(coalesce({c} = 'Yes', false) AS INTEGER)" for c in
                    ("PhoneService", "MultipleLines", "Partner", "Dependents") + _NET)

cte("eng0", _eng0(False, False), ("subscribers",))
cte("eng", f"""
SELECT *,
  CASE WHEN tenure > -1 AND tenure <= 12 THEN '0-1y' WHEN tenure > 12 AND tenure <= 24 THEN '1-2y'
       WHEN tenure > 24 AND tenure <= 48 THEN '2-4y' WHEN tenure > 48 AND tenure <= 80 THEN '4-6y'
       WHEN tenure > 80 AND tenure <= 120 THEN '6-10y' END AS Tenure_Bucket,
  {_COUNT} AS Service_Count,
  TotalCharges / (coalesce(tenure, 0.0) + 1) AS Avg_Historical_Charge,
  CASE WHEN contains(lower(PaymentMethod), 'automatic') THEN 'Automatic' ELSE 'Manual' END AS Payment_Simple
FROM eng0""", ("eng0",))

cte("eng0_v1", _eng0(False, True), ("subscribers",))
cte("eng_v1", f"""
SELECT *,
  CASE WHEN tenure > -1 AND tenure <= 12 THEN '0-1y' WHEN tenure > 12 AND tenure <= 24 THEN '1-2y'
       WHEN tenure > 24 AND tenure <= 48 THEN '2-4y' WHEN tenure > 48 AND tenure <= 80 THEN '4-6y+'
       END AS Tenure_Bucket,
  {_COUNT} AS Service_Count,
  TotalCharges / (tenure + 1) AS Avg_Historical_Charge,
  CASE WHEN contains(PaymentMethod, 'automatic') THEN 'Automatic' ELSE 'Manual' END AS Payment_Simple
FROM eng0_v1""", ("eng0_v1",))

# CLV on the engineered table (H1/H2 with the fixed policy values)
cte("valued", """
SELECT *,
  coalesce(MonthlyCharges, 0.0) * 0.6 AS monthly_margin,
  coalesce(tenure, 0.0) + 12 AS remaining_months_proxy,
  coalesce(MonthlyCharges, 0.0) * 0.6 * (coalesce(tenure, 0.0) + 12) AS clv
FROM eng""", ("eng",))
