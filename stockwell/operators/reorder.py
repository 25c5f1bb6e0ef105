"""Safety stock, reorder point, reorder quantity and stock on hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwell.functions import divide, greatest_strict, run_timestamp
from stockwell.operators.ranking import abc_classify
from stockwell.params import REORDER_RUNNER, REORDER_SQL, ReorderParams

STAGE_COLUMNS = (
    "product_id",
    "sku",
    "product_name",
    "category",
    "price",
    "current_stock",
    "avg_daily_demand_30d",
    "avg_daily_demand_60d",
    "avg_daily_demand_90d",
    "revenue_30d",
    "revenue_90d",
    "demand_std_dev",
    "observation_days",
    "avg_lead_time_days",
    "safety_stock",
    "reorder_point",
    "reorder_qty",
    "abc_class",
    "cumulative_revenue_pct",
    "computed_at",
)


def lead_root(lead_days: Column) -> Column:
    """Square root of the lead time; a negative lead time fails the job."""
    return F.when(
        lead_days < 0, F.raise_error(F.lit("negative lead time")).cast("double")
    ).otherwise(F.sqrt(lead_days))


def safety_stock(std_dev: Column, lead_days: Column, z_score: float) -> Column:
    return F.lit(z_score) * std_dev * lead_root(lead_days)


def lead_demand(daily_demand: Column, lead_days: Column) -> Column:
    return daily_demand * lead_days


def reorder_quantity(demand: Column, std_dev: Column, on_zero: str) -> Column:
    """Lead-time demand over its variability, at least 1.

    Without variability the rule is ``on_zero``; the fallback orders the
    lead-time demand itself. A NULL stays NULL.
    """
    raw = F.ceil(divide(demand, std_dev, on_zero, fallback=demand, what="demand_std_dev"))
    return greatest_strict(raw, F.lit(1).cast("bigint"))


def current_stock_proxy(daily_demand: Column, params: ReorderParams = REORDER_SQL) -> Column:
    """Stock left from a fixed opening level after the lookback's sales."""
    sold = F.coalesce(daily_demand * params.windows[-1], F.lit(0.0))
    return F.greatest(F.lit(params.stock_base) - sold, F.lit(0.0))


def reorder_metrics_sql(
    products: DataFrame,
    velocity: DataFrame,
    on_zero: str = "error",
    params: ReorderParams = REORDER_SQL,
    stock: DataFrame | None = None,
) -> DataFrame:
    """Every product with velocity defaults filled in and reorder metrics.

    ``stock`` (product_id, current_stock) replaces the sell-through proxy.
    """
    joined = products.join(velocity, "product_id", "left")
    on_hand = current_stock_proxy(F.col("avg_daily_demand_90d"), params)
    if stock is not None:
        known = stock.select("product_id", F.col("current_stock").alias("_stock"))
        joined = joined.join(known, "product_id", "left")
        on_hand = F.coalesce(F.col("_stock").cast("double"), on_hand)
    zero = F.lit(0.0)
    filled = joined.select(
        "product_id",
        "sku",
        "product_name",
        "category",
        "price",
        on_hand.alias("current_stock"),
        F.coalesce("avg_daily_demand_30d", zero).alias("avg_daily_demand_30d"),
        F.coalesce("avg_daily_demand_60d", zero).alias("avg_daily_demand_60d"),
        F.coalesce("avg_daily_demand_90d", zero).alias("avg_daily_demand_90d"),
        F.coalesce("revenue_30d", F.lit(0)).alias("revenue_30d"),
        F.coalesce("revenue_90d", F.lit(0)).alias("revenue_90d"),
        F.coalesce("demand_std_dev", zero).alias("demand_std_dev"),
        F.coalesce("observation_days", F.lit(0)).alias("observation_days"),
        F.coalesce("avg_lead_time_days", F.lit(params.default_lead_days)).alias("avg_lead_time_days"),
    )
    std_dev, lead = F.col("demand_std_dev"), F.col("avg_lead_time_days")
    demand = lead_demand(F.col("avg_daily_demand_90d"), lead)
    buffer = safety_stock(std_dev, lead, params.z_score)
    return filled.withColumns(
        {
            "safety_stock": buffer,
            "reorder_point": demand + buffer,
            "reorder_qty": reorder_quantity(demand, std_dev, on_zero),
        }
    )


def reorder_stage(metrics: DataFrame, run_ts) -> DataFrame:
    """The 20-column stage: metrics, ABC class and one run timestamp."""
    classed = abc_classify(metrics, "revenue_90d", "product_id")
    return classed.withColumn("computed_at", run_timestamp(run_ts)).select(*STAGE_COLUMNS)


def reorder_metrics_runner(
    velocity: DataFrame,
    lookback_days: int = 90,
    lead_time_override: float | None = None,
    on_zero: str = "error",
    params: ReorderParams = REORDER_RUNNER,
) -> DataFrame:
    """Whole-unit metrics from line statistics; stock on hand is not known."""
    lead = F.lit(float(params.default_lead_days if lead_time_override is None else lead_time_override))
    daily = F.col("total_qty_sold").cast("double") / lookback_days
    std_dev = F.col("std_qty_per_order")
    daily_std = std_dev / F.sqrt(F.lit(float(lookback_days))) if lookback_days > 0 else F.lit(0.0)
    buffer = F.ceil(safety_stock(daily_std, lead, params.z_score))
    demand = lead_demand(daily, lead)
    none = F.lit(0).cast("bigint")
    return velocity.select(
        *velocity.columns,
        none.alias("current_stock"),
        reorder_quantity(demand, std_dev, on_zero).alias("reorder_qty"),
        greatest_strict(F.ceil(demand) + buffer, none).alias("reorder_point"),
        greatest_strict(buffer, none).alias("safety_stock"),
    )


def reorder_plan_runner(metrics: DataFrame, run_ts) -> DataFrame:
    """The eight target columns with ABC classes by all-time revenue."""
    needed = metrics.select(
        "product_id", "sku", "current_stock", "reorder_qty", "reorder_point", "safety_stock", "total_revenue"
    )
    classed = abc_classify(needed, "total_revenue", "product_id")
    return classed.withColumn("computed_at", run_timestamp(run_ts)).select(
        "product_id",
        "sku",
        "current_stock",
        "reorder_qty",
        "reorder_point",
        "safety_stock",
        "abc_class",
        "computed_at",
    )
