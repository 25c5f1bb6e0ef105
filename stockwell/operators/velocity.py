"""Sales velocity, demand variability and lead times per product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.functions import day_gap, days_before, population_variance
from stockwell.operators.customers import completed_orders
from stockwell.params import COMPLETED, REORDER_SQL, ReorderParams
from stockwell.schemas import exact

VELOCITY_COLUMNS = (
    "product_id",
    "avg_daily_demand_30d",
    "avg_daily_demand_60d",
    "avg_daily_demand_90d",
    "revenue_30d",
    "revenue_90d",
    "active_selling_days",
    "demand_std_dev",
    "demand_variance",
    "min_daily_units",
    "max_daily_units",
    "observation_days",
    "avg_lead_time_days",
)


def recent_completed_lines(
    items: DataFrame,
    orders: DataFrame,
    reference_date: dt.date,
    lookback_days: int = 90,
    date_partition: str | None = None,
) -> DataFrame:
    """Order lines of completed orders inside the lookback, with lead days.

    ``date_partition`` names a column holding the date of ``created_at`` by
    which the lines are stored; older partitions are then never listed.
    """
    cutoff = days_before(reference_date, lookback_days)
    if date_partition:
        items = items.filter(F.col(date_partition) >= cutoff)
    recent = items.filter(F.col("created_at") >= cutoff).select(
        "order_id",
        "product_id",
        "created_at",
        exact(items, "quantity", 2).alias("quantity"),
        exact(items, "line_total", 4).alias("line_total"),
    )
    done = completed_orders(orders).select(
        "order_id", day_gap(F.col("order_date"), F.col("order_updated_at")).alias("lead_days")
    )
    return recent.join(done, "order_id")


def daily_sales(lines: DataFrame) -> DataFrame:
    """One row per product and day.

    Lead-time sums ride along, so lead times need no second join or scan.
    """
    return lines.groupBy("product_id", F.to_date("created_at").alias("sale_date")).agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total").alias("revenue"),
        F.sum("lead_days").alias("lead_days"),
        F.count("lead_days").alias("lead_lines"),
    )


def sales_velocity(
    daily: DataFrame,
    reference_date: dt.date,
    params: ReorderParams = REORDER_SQL,
    lead_time_override: float | None = None,
) -> DataFrame:
    """All windows, variability and lead time from one pass over daily rows."""
    short, middle, long_ = params.windows
    units, revenue = F.col("units_sold"), F.col("revenue")

    def within(days: int, measure):
        return F.sum(F.when(F.col("sale_date") >= days_before(reference_date, days), measure).otherwise(0))

    sums = daily.groupBy("product_id").agg(
        within(short, units).alias("_units_short"),
        within(middle, units).alias("_units_middle"),
        F.sum(units).alias("_units"),
        within(short, revenue).alias("revenue_30d"),
        F.sum(revenue).alias("revenue_90d"),
        F.count("sale_date").alias("active_selling_days"),
        F.count(F.lit(1)).alias("observation_days"),
        F.count(units).alias("_days_with_units"),
        F.sum(units * units).alias("_units_squared"),
        F.min(units).alias("_min_units"),
        F.max(units).alias("_max_units"),
        F.sum("lead_days").alias("_lead_days"),
        F.sum("lead_lines").alias("_lead_lines"),
    )
    variance = F.coalesce(
        population_variance(F.col("_days_with_units"), F.col("_units"), F.col("_units_squared")), F.lit(0.0)
    )
    history = F.try_divide(F.col("_lead_days").cast("double"), F.col("_lead_lines").cast("double"))
    return sums.select(
        "product_id",
        (F.col("_units_short").cast("double") / short).alias("avg_daily_demand_30d"),
        (F.col("_units_middle").cast("double") / middle).alias("avg_daily_demand_60d"),
        (F.col("_units").cast("double") / long_).alias("avg_daily_demand_90d"),
        "revenue_30d",
        "revenue_90d",
        "active_selling_days",
        F.sqrt(variance).alias("demand_std_dev"),
        variance.alias("demand_variance"),
        F.coalesce("_min_units", F.lit(0)).alias("min_daily_units"),
        F.coalesce("_max_units", F.lit(0)).alias("max_daily_units"),
        "observation_days",
        F.coalesce(F.lit(lead_time_override).cast("double"), history).alias("avg_lead_time_days"),
    )


def lead_times(
    products: DataFrame,
    velocity: DataFrame | None,
    params: ReorderParams = REORDER_SQL,
    override: float | None = None,
) -> DataFrame:
    """Lead days per product: the override, else its history, else the default."""
    default = F.lit(params.default_lead_days)
    if override is not None or velocity is None:
        chosen = F.lit(float(override)) if override is not None else default
        return products.select("product_id", chosen.alias("avg_lead_time_days"))
    known = velocity.select("product_id", F.col("avg_lead_time_days").alias("_history"))
    return products.join(known, "product_id", "left").select(
        "product_id", F.coalesce("_history", default).alias("avg_lead_time_days")
    )


def sales_velocity_runner(
    products: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reference_date: dt.date,
    lookback_days: int = 90,
    strict_window: bool = False,
) -> DataFrame:
    """Per-product line statistics.

    Only ``order_count`` is limited to recent completed orders; the measures
    cover every line of every status. ``strict_window=True`` limits them too.

    Measures never need the orders table, so they are summed straight from the
    scan; the join for the count carries two ids and only qualifying orders.
    The few lines that survive it are exchanged by (product, order), which
    leaves the join free to be split where one order holds very many lines.
    """
    qualifying = orders.filter(
        (F.col("order_date") >= days_before(reference_date, lookback_days))
        & (F.col("order_status") == COMPLETED)
    ).select("order_id")
    lines = items.select(
        "order_id",
        "product_id",
        exact(items, "quantity", 2).alias("quantity"),
        exact(items, "line_total", 4).alias("line_total"),
    )
    quantity = F.col("quantity")
    sums = [
        F.sum(quantity).alias("_qty"),
        F.count(quantity).alias("_lines"),
        F.sum(quantity * quantity).alias("_qty_squared"),
        F.sum("line_total").alias("_revenue"),
    ]
    if strict_window:
        # One join serves the measures and the count: a row of each product and order is summed again by product.
        per_order = lines.join(qualifying, "order_id", "left_semi").groupBy("product_id", "order_id").agg(*sums)
        measures = per_order.groupBy("product_id").agg(
            *[F.sum(c).alias(c) for c in ("_qty", "_lines", "_qty_squared", "_revenue")],
            F.count("order_id").alias("_orders"),
        )
        joined = products.join(measures, "product_id", "left")
    else:
        counts = (
            items.select("order_id", "product_id")
            .join(qualifying, "order_id", "left_semi")
            .repartition("product_id", "order_id")
            .groupBy("product_id")
            .agg(F.count_distinct("order_id").alias("_orders"))
        )
        measures = lines.groupBy("product_id").agg(*sums)
        joined = products.join(measures, "product_id", "left").join(counts, "product_id", "left")
    variance = population_variance(F.col("_lines"), F.col("_qty"), F.col("_qty_squared"))
    return joined.select(
        "product_id",
        "sku",
        "product_name",
        "category",
        "price",
        F.coalesce("_orders", F.lit(0)).alias("order_count"),
        F.coalesce("_qty", F.lit(0)).alias("total_qty_sold"),
        F.coalesce(
            F.try_divide(F.col("_qty").cast("double"), F.col("_lines").cast("double")), F.lit(0.0)
        ).alias("avg_qty_per_order"),
        F.coalesce(F.sqrt(variance), F.lit(0.0)).alias("std_qty_per_order"),
        F.coalesce("_revenue", F.lit(0)).alias("total_revenue"),
    )
