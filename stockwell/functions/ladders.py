"""Threshold ladders for tiers and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockwell import params


def _floor_ladder(value: Column, steps, lowest: str) -> Column:
    result = F.lit(lowest)
    for label, floor in reversed(steps):
        result = F.when(value >= floor, label).otherwise(result)
    return result


def _ceiling_ladder(value: Column, steps, top: str) -> Column:
    result = F.lit(top)
    for label, ceiling in reversed(steps):
        result = F.when(value <= ceiling, label).otherwise(result)
    return result


def ltv_tier(score: Column) -> Column:
    """A NULL score lands in the lowest tier."""
    return _floor_ladder(score, params.LTV_TIERS, params.LTV_LOWEST_TIER)


def abc_class(cumulative_share: Column, thresholds=params.ABC_THRESHOLDS) -> Column:
    """The row that crosses a threshold takes the lower class; NULL is lowest."""
    return _ceiling_ladder(cumulative_share, thresholds, params.ABC_LOWEST_CLASS)


def revenue_tier(amount: Column) -> Column:
    """Right-closed bins: exactly 100 is low, exactly 1000 is medium."""
    return F.when(
        amount.isNotNull() & ~F.isnan(amount.cast("double")),
        _ceiling_ladder(amount, params.REVENUE_TIERS, params.REVENUE_TOP_TIER),
    )
