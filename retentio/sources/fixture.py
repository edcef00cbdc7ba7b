"""Subscriber table derived from the driver's `customer` and `orders`.

Features use orders before the cut-off; the label uses orders on or after
it. Both sides are keyed by customer: orders are pre-aggregated per
customer (partial aggregation before the shuffle, so a customer holding a
third of all orders costs one partial row per task), then joined 1:1.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.labels import inactivity_days
from .tables import table

CUTOFF = dt.date(2000, 8, 1)
CHURN_GAP_DAYS = 180

# ---- fixed values: fixture derivation rules ------------------------------
INTERNET_BY_NATION_MOD3 = ("No", "DSL", "Fiber optic")
PAYMENT_BY_KEY_MOD4 = ("Electronic check", "Mailed check",
                       "Bank transfer (automatic)", "Credit card (automatic)")
FLAG_RULES = (  # column, modulus p, 'Yes' when c_custkey % p < k
    ("MultipleLines", 2, 1), ("OnlineSecurity", 3, 1), ("OnlineBackup", 5, 2),
    ("DeviceProtection", 7, 3), ("TechSupport", 11, 4), ("StreamingTV", 13, 6),
    ("StreamingMovies", 17, 8), ("Partner", 19, 9), ("Dependents", 23, 7),
)
MONTH_TO_MONTH_SEGMENTS = ("BUILDING", "MACHINERY", "AUTOMOBILE")
ONE_YEAR_SEGMENTS = ("FURNITURE",)
# ---------------------------------------------------------------------------


def _pick(idx: Column, values: tuple) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(idx == i, F.lit(v)) if expr is None
                else expr.when(idx == i, F.lit(v)))
    return expr


def order_activity(orders: DataFrame, cutoff: dt.date = CUTOFF) -> DataFrame:
    """Per customer: first order before the cut-off, last order, any order
    on/after the cut-off."""
    c = F.lit(cutoff)
    d = F.col("o_orderdate").cast("date")
    return (orders.select(F.col("o_custkey").alias("c_custkey"), d.alias("d"))
            .groupBy("c_custkey")
            .agg(F.min(F.when(F.col("d") < c, F.col("d"))).alias("first_before"),
                 F.max("d").alias("last_order"),
                 F.max((F.col("d") >= c).cast("int")).alias("has_after")))


def subscribers_from(customer: DataFrame, orders: DataFrame,
                     cutoff: dt.date = CUTOFF, gap_days: int = CHURN_GAP_DAYS,
                     with_days_to_churn: bool = True) -> DataFrame:
    c = F.lit(cutoff)
    act = order_activity(orders, cutoff)
    base = (customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .join(act, "c_custkey", "left")
            .withColumn("months", F.floor(F.datediff(c, F.col("first_before")) / 30)))
    key, nat, months = F.col("c_custkey"), F.col("c_nationkey"), F.col("months")

    tenure = (F.when(months.isNull(), F.lit(None).cast("double"))
              .when(key % 101 == 0, F.lit(-1.0))
              .when(key % 103 == 0, F.lit(130.0))
              .otherwise(months.cast("double")))
    total = F.when((key % 97 == 0) | months.isNull(), F.lit(" ")).otherwise(
        F.floor(F.col("c_acctbal") / 100 * months).cast("bigint").cast("string"))
    seg = F.col("c_mktsegment")
    contract = (F.when(seg.isin(*MONTH_TO_MONTH_SEGMENTS), "Month-to-month")
                .when(seg.isin(*ONE_YEAR_SEGMENTS), "One year")
                .otherwise("Two year"))
    payment = F.when(key % 89 == 0, F.lit(None).cast("string")).otherwise(
        _pick(key % 4, PAYMENT_BY_KEY_MOD4))
    churned = F.coalesce(F.col("has_after"), F.lit(0)) == 0

    cols = [
        key.cast("string").alias("customerID"),
        tenure.alias("tenure"),
        (F.col("c_acctbal") / 100).alias("MonthlyCharges"),
        total.alias("TotalCharges"),
        _pick(nat % 3, INTERNET_BY_NATION_MOD3).alias("InternetService"),
        F.when(nat % 5 == 0, "No").otherwise("Yes").alias("PhoneService"),
    ]
    cols += [F.when(key % p < k, "Yes").otherwise("No").alias(name)
             for name, p, k in FLAG_RULES]
    cols += [contract.alias("Contract"), payment.alias("PaymentMethod"),
             F.when(churned, "Yes").otherwise("No").alias("Churn")]
    if with_days_to_churn:
        cols.append(inactivity_days(churned, F.col("last_order"), cutoff, gap_days)
                    .alias("days_to_churn"))
    return base.select(*cols)


def subscribers(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return subscribers_from(table(spark, sf_dir, "customer"),
                            table(spark, sf_dir, "orders"), **kw)
