"""Cleaning and feature engineering.

All operators are `DataFrame -> DataFrame` projections: one narrow stage,
no shuffle, inside whole-stage codegen. Presence of optional columns is
checked against the schema on the driver (metadata only), as the
reference guards each rule by "column present?".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cleaning as C

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
LEAK_COLUMNS = ("Churn", "Churn_Target", "days_to_churn", "y_30d", "y_60d", "y_90d")
# columns of a labelled table that are no model input
MODEL_EXCLUDE = ("customerID", "is_test") + LEAK_COLUMNS


def basic_clean(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """B1 + B2/B3: lenient TotalCharges, binary Churn_Target."""
    cols = {}
    if "TotalCharges" in df.columns:
        cols["TotalCharges"] = C.lenient_double("TotalCharges")
    if "Churn" in df.columns:
        cols["Churn_Target"] = C.churn_target("Churn", case_sensitive)
    return df.withColumns(cols) if cols else df


def feature_engineer(df: DataFrame, profile: str = "v2") -> DataFrame:
    """B4-B14 in one projection. `profile` selects the v2 library rules or
    the v1 trainer rules (bins, NULL tenure in the average, payment case)."""
    if profile not in ("v1", "v2"):
        raise ValueError("profile must be 'v1' or 'v2'")
    v1 = profile == "v1"
    have = set(df.columns)
    cols = {}

    if "InternetService" in have:
        no_net = F.col("InternetService") == "No"
        for c in C.INTERNET_COLS:
            if c in have:
                cols[c] = C.repair_if(no_net, C.NO_INTERNET, c)
    if "PhoneService" in have and "MultipleLines" in have:
        cols["MultipleLines"] = C.repair_if(F.col("PhoneService") == "No", C.NO_PHONE,
                                            "MultipleLines")

    tenure = None
    if "tenure" in have:
        tenure = C.in_range_or_null("tenure", C.TENURE_MIN, C.TENURE_MAX)
        cols["tenure"] = tenure
        cols["Tenure_Bucket"] = C.right_closed_bins(
            tenure, C.TENURE_BINS_V1 if v1 else C.TENURE_BINS_V2)
    if "MonthlyCharges" in have:
        cols["MonthlyCharges"] = C.non_negative_or_null("MonthlyCharges")

    counted = [c for c in C.COUNTED_COLS if c in have]
    if counted:
        # count over the repaired values
        cols["Service_Count"] = C.yes_count([cols.get(c, F.col(c)) for c in counted])

    if "TotalCharges" in have and tenure is not None:
        cols["Avg_Historical_Charge"] = C.avg_historical_charge(
            "TotalCharges", tenure, fill_tenure=not v1)
    if "PaymentMethod" in have:
        cols["Payment_Simple"] = C.payment_simple("PaymentMethod", case_sensitive=v1)

    return df.withColumns(cols)


def engineered(raw: DataFrame, profile: str = "v2") -> DataFrame:
    """Raw subscribers -> engineered table."""
    return feature_engineer(basic_clean(raw, case_sensitive=(profile == "v1")), profile)


def drop_columns(df: DataFrame, names=LEAK_COLUMNS) -> DataFrame:
    """Drop leak/id columns; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def normalize_keys(df: DataFrame, key: str = "customerID") -> DataFrame:
    """B16."""
    return df.withColumn(key, C.normalize_key(key))


def carry_forward(target: DataFrame, source: DataFrame, cols, key: str = "customerID") -> DataFrame:
    """Bring context columns onto `target` by key, only those that are
    missing there. Both sides are keyed 1:1, so this is a co-partitioned
    equi-join (hash on `key`), never a positional assignment."""
    missing = [c for c in cols if c in source.columns and c not in target.columns]
    if not missing:
        return target
    return target.join(source.select(key, *missing), key, "left")


def filter_in(df: DataFrame, **allowed) -> DataFrame:
    """Keep rows whose column values are in the given sets (AND)."""
    for c, values in allowed.items():
        if values is not None:
            df = df.filter(F.col(c).isin(list(values)))
    return df


# ---- fixed values: value-segment ranks --------------------------------------
SEGMENT_RANK = {"low": 0, "mid": 1, "high": 2}
# -----------------------------------------------------------------------------


def min_segment_rank(df: DataFrame, minimum: str, col: str = "value_segment") -> DataFrame:
    """Segment rank >= rank(minimum); segments without a rank drop."""
    seg = F.col(col)
    rank = None
    for name, r in SEGMENT_RANK.items():
        rank = F.when(seg == name, r) if rank is None else rank.when(seg == name, r)
    return df.filter(rank >= SEGMENT_RANK[minimum])


def min_segment_list(df: DataFrame, minimum: str, col: str = "value_segment") -> DataFrame:
    """All -> no filter; mid -> {mid, high}; high -> {high}."""
    if minimum == "all":
        return df
    keep = ["mid", "high"] if minimum == "mid" else ["high"]
    return df.filter(F.col(col).isin(keep))


def only_flagged(df: DataFrame, col: str = "should_intervene") -> DataFrame:
    """B21."""
    return df.filter(F.col(col) == 1)


def cohort(df: DataFrame, score: str, threshold, side: str = "at_risk") -> DataFrame:
    """at_risk (p >= t), safe (p < t), above (p > t, drill-down list)."""
    p = F.col(score)
    cond = {"at_risk": p >= threshold, "safe": p < threshold, "above": p > threshold}[side]
    return df.filter(cond)


def drop_null(df: DataFrame, col: str) -> DataFrame:
    """B24."""
    return df.dropna(subset=[col])


def with_tenure_display(df: DataFrame, col: str = "tenure") -> DataFrame:
    """B25/B26."""
    out = df.withColumns({"tenure_years": C.tenure_years(col),
                          "tenure_display": C.tenure_text(col)})
    if "Churn_Target" in df.columns:
        out = out.withColumn("Churn_Label", C.churn_label_text("Churn_Target"))
    return out


def split_by_dtype(df: DataFrame, exclude=("customerID",)) -> tuple[list[str], list[str]]:
    """Numeric vs categorical columns from the schema (driver metadata)."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.BooleanType)):
            cat.append(f.name)
    return num, cat


def project_existing(df: DataFrame, cols) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])
