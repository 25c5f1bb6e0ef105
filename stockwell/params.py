"""Model constants. The two profiles disagree on purpose; never blend them."""

from __future__ import annotations

import math
from dataclasses import dataclass

PROFILES = ("sql", "runner")
ZERO_POLICIES = ("error", "null", "fallback")

# Fixed values -----------------------------------------------------------
COMPLETED = "completed"
HALF_LIFE_DAYS = 180.0
LTV_TIERS = (("PLATINUM", 5000), ("GOLD", 2000), ("SILVER", 500))
LTV_LOWEST_TIER = "BRONZE"
ABC_THRESHOLDS = (("A", 0.80), ("B", 0.95))
ABC_LOWEST_CLASS = "C"
REVENUE_TIERS = (("low", 100.0), ("medium", 1000.0))
REVENUE_TOP_TIER = "high"
SALES_VERSION = "1.4.2"
# End of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class LtvParams:
    profile: str
    decay_per_day: float
    recent_revenue_months: int = 12
    recent_orders_months: int = 3
    orders_for_full_frequency: float = 10.0
    base_weight: float = 0.7
    frequency_weight: float = 0.3
    uplift_per_order: float = 0.02


@dataclass(frozen=True)
class ReorderParams:
    profile: str
    z_score: float
    default_lead_days: float
    lookback_days: int = 90
    windows: tuple[int, int, int] = (30, 60, 90)
    stock_base: float = 1000.0


LTV_SQL = LtvParams("sql", decay_per_day=0.003851)
LTV_RUNNER = LtvParams("runner", decay_per_day=math.log(2) / HALF_LIFE_DAYS)
REORDER_SQL = ReorderParams("sql", z_score=1.645, default_lead_days=7.0)
REORDER_RUNNER = ReorderParams("runner", z_score=1.65, default_lead_days=14.0)


def ltv_params(profile: str) -> LtvParams:
    return {"sql": LTV_SQL, "runner": LTV_RUNNER}[profile]


def reorder_params(profile: str) -> ReorderParams:
    return {"sql": REORDER_SQL, "runner": REORDER_RUNNER}[profile]
