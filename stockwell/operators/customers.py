"""Per-customer order statistics and recency features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockwell.functions import day_gap, divide, month_gap, months_before
from stockwell.params import COMPLETED, LtvParams, ltv_params
from stockwell.schemas import exact


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == COMPLETED).select(
        "order_id", "customer_id", "order_date", "order_updated_at"
    )


def order_revenue(items: DataFrame) -> DataFrame:
    """One row per order: the map-side combine absorbs orders of any size."""
    return items.groupBy("order_id").agg(
        F.sum(exact(items, "line_total", 4)).alias("order_revenue"),
        F.sum(exact(items, "quantity", 2)).alias("order_units"),
        F.count("line_total").alias("line_count"),
    )


def _order_facts(orders: DataFrame, items: DataFrame, reference_date: dt.date, p: LtvParams) -> DataFrame:
    """One row per (customer, order) with every partial the customer row needs.

    The join leaves rows hashed by order_id, so this grouping adds no exchange,
    and afterwards a plain count per customer is the distinct order count.
    """
    joined = completed_orders(orders).join(order_revenue(items), "order_id", "left")
    in_year = F.col("order_date") >= months_before(reference_date, p.recent_revenue_months)
    in_quarter = F.col("order_date") >= months_before(reference_date, p.recent_orders_months)
    return joined.groupBy("customer_id", "order_id").agg(
        F.sum("order_revenue").alias("revenue"),
        F.count("order_revenue").alias("priced_orders"),
        F.sum("order_units").alias("units"),
        F.sum("line_count").alias("lines"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.sum(F.when(in_year, F.col("order_revenue")).otherwise(0)).alias("year_revenue"),
        F.max(in_quarter).alias("in_quarter"),
    )


def customer_order_stats(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    reference_date: dt.date,
    profile: str = "sql",
    as_of: bool = False,
) -> DataFrame:
    """Order statistics for every customer, zero-order customers included.

    ``profile="sql"`` averages order totals and leaves revenue NULL where no
    line exists; ``profile="runner"`` averages line totals and defaults to 0.
    ``as_of=True`` ignores orders placed after ``reference_date``.

    Orders are reduced to one row per customer before customers are joined, so
    a customer with a third of all orders is never gathered in one task.
    """
    p = ltv_params(profile)
    if as_of:
        orders = orders.filter(F.col("order_date") <= F.lit(reference_date))
    facts = _order_facts(orders, items, reference_date, p)
    per_customer = facts.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("priced_orders").alias("_priced_orders"),
        F.sum("units").alias("total_units"),
        F.sum("lines").alias("_lines"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
        F.sum("year_revenue").alias("_year_revenue"),
        F.count_if("in_quarter").alias("_quarter_orders"),
    )
    people = customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        F.col("created_at").alias("customer_since"),
    )
    joined = people.join(per_customer, "customer_id", "left").withColumn(
        "_no_orders", F.col("order_count").isNull()
    )
    identity = ["customer_id", "first_name", "last_name", "email", "customer_since"]
    order_count = F.coalesce("order_count", F.lit(0)).alias("order_count")
    if profile == "runner":
        return joined.select(
            *identity,
            order_count,
            F.coalesce("total_revenue", F.lit(0)).alias("total_revenue"),
            F.coalesce(
                F.try_divide(F.col("total_revenue").cast("double"), F.col("_lines").cast("double")),
                F.lit(0.0),
            ).alias("avg_order_value"),
            "first_order_date",
            "last_order_date",
        )
    return joined.select(
        *identity,
        order_count,
        "total_revenue",
        F.try_divide(F.col("total_revenue").cast("double"), F.col("_priced_orders").cast("double")).alias(
            "avg_order_value"
        ),
        "total_units",
        "first_order_date",
        "last_order_date",
        F.when(F.col("_no_orders"), 0).otherwise(F.col("_year_revenue")).alias("revenue_last_12m"),
        F.coalesce("_quarter_orders", F.lit(0)).alias("orders_last_3m"),
    )


def by_revenue(stats: DataFrame) -> DataFrame:
    """Largest total revenue first, for showing a result. Not for a write."""
    return stats.orderBy(F.col("total_revenue").desc_nulls_first())


def recency_features(stats: DataFrame, reference_date: dt.date) -> DataFrame:
    """Recency and tenure for customers with at least one completed order."""
    today = F.lit(reference_date)
    return stats.filter(F.col("order_count") > 0).withColumns(
        {
            "days_since_last_order": day_gap(F.col("last_order_date"), today),
            "tenure_months": month_gap(F.col("first_order_date"), today),
            "avg_days_between_orders": F.when(
                F.col("order_count") > 1,
                divide(
                    day_gap(F.col("first_order_date"), F.col("last_order_date")),
                    F.col("order_count") - 1,
                    on_zero="null",
                ),
            ),
        }
    )
