"""Policy configuration.

The numbers below are fixed values that must equal the reference policy
for identical results (margin, horizon, offer costs, risk weights, value
cuts, evaluation costs, capacity defaults).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, asdict

# ---- fixed values -------------------------------------------------------
MARGIN_RATE = 0.6
EXPECTED_FUTURE_MONTHS = 12
OFFER_COSTS = {
    "discount_offer": 40.0,
    "contract_incentive": 60.0,
    "support_intervention": 15.0,
    "service_quality_check": 10.0,
    "autopay_nudge": 5.0,
}
RISK_WEIGHTS = (0.6, 0.3, 0.1)          # w30, w60, w90
HIGH_VALUE_CLV = 1000.0
MID_VALUE_CLV = 400.0
COST_FN = 200.0                         # cost of a missed churner
COST_FP = 50.0                          # cost of an unneeded offer
CALLS_PER_WEEK = 200                    # high-touch capacity
CRITICAL_PROB = 0.85                    # v1 critical cut
RISK_WINDOWS = (30, 60, 90)
VALUE_QUANTILES = (0.33, 0.66)
# -------------------------------------------------------------------------


@dataclass(frozen=True)
class RetentionPolicy:
    margin_rate: float = MARGIN_RATE
    expected_future_months: int = EXPECTED_FUTURE_MONTHS
    costs: dict = field(default_factory=lambda: dict(OFFER_COSTS))
    w30: float = RISK_WEIGHTS[0]
    w60: float = RISK_WEIGHTS[1]
    w90: float = RISK_WEIGHTS[2]
    high_value_clv: float = HIGH_VALUE_CLV
    mid_value_clv: float = MID_VALUE_CLV

    @staticmethod
    def from_dict(cfg: dict) -> "RetentionPolicy":
        """Accepts the nested JSON layout (risk_weights / value_segments)."""
        rw = cfg.get("risk_weights", {})
        vs = cfg.get("value_segments", {})
        return RetentionPolicy(
            margin_rate=float(cfg.get("margin_rate", MARGIN_RATE)),
            expected_future_months=int(cfg.get("expected_future_months", EXPECTED_FUTURE_MONTHS)),
            costs={k: float(v) for k, v in cfg.get("costs", OFFER_COSTS).items()},
            w30=float(rw.get("w30", RISK_WEIGHTS[0])),
            w60=float(rw.get("w60", RISK_WEIGHTS[1])),
            w90=float(rw.get("w90", RISK_WEIGHTS[2])),
            high_value_clv=float(vs.get("high_value_clv", HIGH_VALUE_CLV)),
            mid_value_clv=float(vs.get("mid_value_clv", MID_VALUE_CLV)),
        )

    def to_dict(self) -> dict:
        d = asdict(self)
        return {
            "margin_rate": d["margin_rate"],
            "expected_future_months": d["expected_future_months"],
            "costs": d["costs"],
            "risk_weights": {"w30": d["w30"], "w60": d["w60"], "w90": d["w90"]},
            "value_segments": {"high_value_clv": d["high_value_clv"],
                               "mid_value_clv": d["mid_value_clv"]},
        }

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), indent=2)


@dataclass(frozen=True)
class LiveParams:
    """Business constraints of the live dashboard view."""
    cost_fn: float = COST_FN
    cost_fp: float = COST_FP
    use_fixed_ltv: bool = False
    calls_per_week: int = CALLS_PER_WEEK
    risk_window: str = "risk_30d"
    min_value_segment: str = "mid"      # all | mid | high
    only_intervene: bool = True
