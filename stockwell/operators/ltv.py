"""Lifetime-value scores, tiers and ranks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.functions import (
    day_gap,
    divide,
    least_strict,
    ltv_tier,
    month_gap,
    retention,
    round_half_even,
    run_timestamp,
)
from stockwell.operators.ranking import Order, with_orders
from stockwell.params import LTV_RUNNER, LTV_SQL

STAGE_COLUMNS = (
    "customer_id",
    "ltv_score",
    "ltv_tier",
    "predicted_revenue_12m",
    "churn_risk_score",
    "total_revenue",
    "order_count",
    "avg_order_value",
    "first_order_date",
    "last_order_date",
    "days_since_last_order",
    "tenure_months",
    "avg_monthly_revenue",
    "retention_factor",
    "frequency_score",
    "revenue_last_12m",
    "ltv_pct_rank",
    "revenue_pct_rank",
    "ltv_global_rank",
    "computed_at",
)


def _monthly_revenue(on_zero: str):
    revenue = F.col("total_revenue")
    return divide(revenue, F.col("tenure_months"), on_zero, fallback=revenue, what="tenure_months")


def score_sql(features: DataFrame, on_zero: str = "error", params=LTV_SQL) -> DataFrame:
    """Unrounded score blending run-rate, retention and order frequency."""
    return (
        features.withColumns(
            {
                "retention_factor": retention(F.col("days_since_last_order"), params.decay_per_day),
                "avg_monthly_revenue": _monthly_revenue(on_zero),
                "frequency_score": least_strict(
                    F.col("orders_last_3m") / F.lit(params.orders_for_full_frequency), F.lit(1.0)
                ),
            }
        )
        .withColumns(
            {
                "predicted_revenue_12m": F.col("avg_monthly_revenue") * 12.0 * F.col("retention_factor"),
                "churn_risk_score": 1.0 - F.col("retention_factor"),
            }
        )
        .withColumn(
            "ltv_score",
            F.col("predicted_revenue_12m")
            * (F.lit(params.base_weight) + F.lit(params.frequency_weight) * F.col("frequency_score")),
        )
        .withColumn("ltv_tier", ltv_tier(F.col("ltv_score")))
    )


def score_runner(
    stats: DataFrame, reference_date: dt.date, on_zero: str = "error", params=LTV_RUNNER
) -> DataFrame:
    """Rounded score with an uplift per order; zero-order customers are kept."""
    today = F.lit(reference_date)
    idle = (F.col("order_count") == 0) | F.col("first_order_date").isNull()
    timed = stats.withColumns(
        {
            "tenure_months": month_gap(F.to_date("first_order_date"), today),
            "retention_factor": F.when(F.col("last_order_date").isNull(), 0.0).otherwise(
                retention(day_gap(F.to_date("last_order_date"), today), params.decay_per_day)
            ),
        }
    )
    uplift = 1 + F.col("order_count") * F.lit(params.uplift_per_order)
    return (
        timed.withColumn(
            "_forecast",
            F.when(~idle, _monthly_revenue(on_zero) * 12.0 * F.col("retention_factor")),
        )
        .withColumn(
            "predicted_revenue_12m",
            F.when(idle, 0.0).otherwise(round_half_even(F.col("_forecast"), 2)),
        )
        .withColumn("_uplifted", F.col("predicted_revenue_12m") * uplift)
        .withColumn("_churn", 1.0 - F.col("retention_factor"))
        .withColumns(
            {
                "ltv_score": F.when(idle, 0.0).otherwise(round_half_even(F.col("_uplifted"), 2)),
                "churn_risk_score": F.when(idle, 1.0).otherwise(round_half_even(F.col("_churn"), 4)),
            }
        )
        .withColumn("ltv_tier", ltv_tier(F.col("ltv_score")))
        .drop("_forecast", "_uplifted", "_churn")
    )


def ltv_ranks(scored: DataFrame) -> DataFrame:
    """Percent ranks by score and by revenue, and the position by score.

    NULL counts as the largest value. Equal scores are numbered by customer_id.
    """
    by_score = Order(
        "ltv_score",
        "customer_id",
        tie_descending=True,
        percent_rank="ltv_pct_rank",
        reverse_row_number="ltv_global_rank",
    )
    return with_orders(scored, by_score, Order("total_revenue", "customer_id", percent_rank="revenue_pct_rank"))


def ltv_stage(scored: DataFrame, run_ts) -> DataFrame:
    """The 20-column stage: ranked scores stamped with one run timestamp.

    Columns are pruned first, because ranking writes the rows it sorts.
    """
    needed = scored.select(*[c for c in STAGE_COLUMNS if c in scored.columns])
    return ltv_ranks(needed).withColumn("computed_at", run_timestamp(run_ts)).select(*STAGE_COLUMNS)
