"""Column expressions for cleaning and feature engineering.

Every function returns a `Column`; nothing here touches rows in Python.
Missing values are SQL NULL, never NaN (in Spark `NaN >= 5` is true).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: column groups, bin edges and labels --------------------
INTERNET_COLS = ("OnlineSecurity", "OnlineBackup", "DeviceProtection",
                 "TechSupport", "StreamingTV", "StreamingMovies")
COUNTED_COLS = ("PhoneService", "MultipleLines", "Partner", "Dependents") + INTERNET_COLS
NO_INTERNET = "No internet service"
NO_PHONE = "No phone service"
TENURE_MIN, TENURE_MAX = 0, 120
# right-closed bins (lo, hi]
TENURE_BINS_V2 = ((-1, 12, "0-1y"), (12, 24, "1-2y"), (24, 48, "2-4y"),
                  (48, 80, "4-6y"), (80, 120, "6-10y"))
TENURE_BINS_V1 = ((-1, 12, "0-1y"), (12, 24, "1-2y"), (24, 48, "2-4y"),
                  (48, 80, "4-6y+"))
# ---------------------------------------------------------------------------


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: str | Column) -> Column:
    """B1: text -> double, anything unparsable or beyond a double -> NULL (ANSI-safe)."""
    text = F.trim(col_or(c).cast("string"))
    number = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    value = text.try_cast("double")
    return F.when(text.rlike(number) & (F.abs(value) < float("inf")), value)


def churn_target(c: str | Column = "Churn", case_sensitive: bool = False) -> Column:
    """B2 (v2, case-insensitive 'yes') / B3 (v1, exact 'Yes'); NULL -> 0."""
    x = col_or(c)
    hit = (x == "Yes") if case_sensitive else (F.lower(x) == "yes")
    return F.coalesce(hit.cast("int"), F.lit(0))


def repair_if(cond: Column, value: str, c: str) -> Column:
    """Overwrite with a fixed label when the condition holds."""
    return F.when(cond, F.lit(value)).otherwise(F.col(c))


def in_range_or_null(c: str | Column, lo: float, hi: float) -> Column:
    """Keep values inside [lo, hi], else NULL."""
    x = col_or(c)
    return F.when((x >= lo) & (x <= hi), x)


def non_negative_or_null(c: str | Column) -> Column:
    """B7."""
    x = col_or(c)
    return F.when((x >= 0) & ~F.isnan(x), x)


def right_closed_bins(c: str | Column, bins=TENURE_BINS_V2) -> Column:
    """Pandas.cut semantics (lo, hi]; outside every bin -> NULL.

    MLlib Bucketizer is left-closed, so a CASE chain on `<=` is used."""
    x = col_or(c)
    expr = None
    for lo, hi, label in bins:
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_ordinal(c: str | Column, bins=TENURE_BINS_V2) -> Column:
    """Ordinal of a bin label, for ordering category outputs."""
    x = col_or(c)
    expr = None
    for i, (_, _, label) in enumerate(bins):
        expr = F.when(x == label, F.lit(i)) if expr is None else expr.when(x == label, F.lit(i))
    return expr


def yes_count(cols) -> Column:
    """Number of exact 'Yes' across the columns (names or Columns;
    NULL counts 0)."""
    parts = [F.coalesce((col_or(c) == "Yes").cast("int"), F.lit(0)) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def avg_historical_charge(total: str | Column = "TotalCharges",
                          tenure: str | Column = "tenure",
                          fill_tenure: bool = True) -> Column:
    """B11 (v2: NULL tenure counts as 0) / B12 (v1: NULL tenure -> NULL)."""
    t = F.coalesce(col_or(tenure), F.lit(0.0)) if fill_tenure else col_or(tenure)
    return col_or(total) / (t + 1)


def payment_simple(c: str | Column = "PaymentMethod", case_sensitive: bool = False) -> Column:
    """B13 (lower-case contains 'automatic') / B14 (case-sensitive).
    NULL -> Manual in both profiles."""
    x = col_or(c)
    probe = x if case_sensitive else F.lower(x)
    return F.when(probe.contains("automatic"), "Automatic").otherwise("Manual")


def normalize_key(c: str | Column = "customerID") -> Column:
    """Text key, surrounding spaces removed."""
    return F.trim(col_or(c).cast("string"))


def tenure_years(c: str | Column = "tenure") -> Column:
    """Months -> years."""
    return col_or(c) / 12.0


def tenure_text(c: str | Column = "tenure") -> Column:
    """B25: '<12' -> 'N months', else 'x.y years'; NULL stays NULL."""
    x = col_or(c)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(x < 12, F.concat(x.cast("bigint").cast("string"), F.lit(" months")))
            # half-even first: Python's '%.1f' rounds exact ties (2.25) to even
            .otherwise(F.format_string("%.1f years", F.bround(x / 12.0, 1))))


def churn_label_text(c: str | Column = "Churn_Target") -> Column:
    """Display label from the binary target."""
    return F.when(col_or(c) == 1, "Yes").otherwise("No")
