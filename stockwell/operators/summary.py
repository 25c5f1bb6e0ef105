"""One-row run summaries."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwell.params import ABC_LOWEST_CLASS, ABC_THRESHOLDS, LTV_LOWEST_TIER, LTV_TIERS

TIER_LABELS = tuple(label for label, _ in LTV_TIERS) + (LTV_LOWEST_TIER,)
ABC_LABELS = tuple(label for label, _ in ABC_THRESHOLDS) + (ABC_LOWEST_CLASS,)


def ltv_facts() -> list[Column]:
    """Aggregates over the scored customers."""
    return [
        F.count(F.lit(1)).alias("customer_count"),
        *[F.count_if(F.col("ltv_tier") == t).alias(f"{t.lower()}_count") for t in TIER_LABELS],
        F.coalesce(F.avg("ltv_score"), F.lit(0.0)).alias("avg_ltv"),
        F.coalesce(F.sum("total_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
    ]


def reorder_facts() -> list[Column]:
    """Aggregates over the planned products."""
    classes = [F.count_if(F.col("abc_class") == c).alias(f"abc_{c.lower()}_count") for c in ABC_LABELS]
    return [F.count(F.lit(1)).alias("product_count"), *classes]


def ltv_summary(stage: DataFrame) -> DataFrame:
    return stage.agg(*ltv_facts())


def reorder_summary(stage: DataFrame) -> DataFrame:
    return stage.agg(*reorder_facts())


def run_text(job: str, run_ts: dt.datetime, *facts: dict) -> str:
    """One log line on a run: its job, its time, and all facts as JSON under their own names."""
    named = {name: value for group in facts for name, value in group.items()}
    return f"{job} {run_ts.isoformat()} {json.dumps(named, default=str)}"
