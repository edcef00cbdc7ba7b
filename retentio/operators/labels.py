"""Targets: time-to-churn (G12) and per-horizon window labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RISK_WINDOWS


def inactivity_days(churned: Column, last_activity: Column, cutoff: dt.date,
                    gap_days: int = 180, cap: int = 365) -> Column:
    """Observed days from the cut-off until a churner counts as gone:
    clip(last activity + gap - cut-off, 0, cap); NULL for non-churners.
    Replaces the reference's random draw with a value derived from data."""
    days = F.datediff(F.date_add(last_activity, gap_days), F.lit(cutoff))
    return F.when(churned, F.least(F.greatest(days, F.lit(0)), F.lit(cap)).cast("double"))


def window_label(days: str | Column, w: int) -> Column:
    """1 when churn happens within w days, else 0 (NULL days -> 0)."""
    d = F.col(days) if isinstance(days, str) else days
    return F.coalesce((d <= w).cast("int"), F.lit(0))


def make_window_labels(df: DataFrame, windows=RISK_WINDOWS, days: str = "days_to_churn") -> DataFrame:
    if days not in df.columns:
        raise ValueError(f"{days} missing: derive it first (inactivity_days)")
    return df.withColumns({f"y_{w}d": window_label(days, w) for w in windows})
