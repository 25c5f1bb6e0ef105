import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockwell.operators.reorder import (
    lead_root,
    reorder_metrics_runner,
    reorder_metrics_sql,
    reorder_quantity,
)
from stockwell.operators.velocity import (
    daily_sales,
    lead_times,
    recent_completed_lines,
    sales_velocity,
    sales_velocity_runner,
)
from stockwell.plans.inventory_reorder import reorder_rows, velocity_sql
from stockwell.schemas import ORDER_ITEMS, ORDERS, PRODUCTS

REF = dt.date(2024, 6, 30)
RUN = dt.datetime(2024, 6, 30, 3)


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def sources(spark):
    products = [(i, f"SKU-{i}", f"p{i}", "c", Decimal("9.99")) for i in (1, 2, 3, 4)]
    orders = [
        (10, 1, dt.date(2024, 6, 20), at("2024-06-24"), "completed"),
        (11, 1, dt.date(2024, 5, 10), at("2024-05-12"), "completed"),
        (12, 1, dt.date(2024, 6, 21), at("2024-06-22"), "open"),
        (13, 1, dt.date(2023, 1, 1), at("2023-01-05"), "completed"),
    ]
    items = [
        # product 1: 4 + 2 units on one day, 3 on another
        (10, 1, Decimal(4), Decimal("40"), at("2024-06-20 10:00")),
        (10, 1, Decimal(2), Decimal("20"), at("2024-06-20 18:00")),
        (11, 1, Decimal(3), Decimal("30"), at("2024-05-10 09:00")),
        # product 2: one selling day, so no variability
        (10, 2, Decimal(5), Decimal("50"), at("2024-06-20 10:00")),
        # product 3: only an open order and one long ago
        (12, 3, Decimal(7), Decimal("70"), at("2024-06-21")),
        (13, 3, Decimal(1), Decimal("5"), at("2023-01-01")),
    ]
    return (
        spark.createDataFrame(products, PRODUCTS),
        spark.createDataFrame(items, ORDER_ITEMS),
        spark.createDataFrame(orders, ORDERS),
    )


def by_id(df):
    return {r["product_id"]: r for r in df.collect()}


def test_daily_sales_groups_by_day(sources):
    _, items, orders = sources
    got = {(r["product_id"], str(r["sale_date"])): (r["units_sold"], r["revenue"])
           for r in daily_sales(recent_completed_lines(items, orders, REF)).collect()}
    assert got == {(1, "2024-06-20"): (6, 60), (1, "2024-05-10"): (3, 30), (2, "2024-06-20"): (5, 50)}


def test_velocity_windows_and_variability(sources):
    _, items, orders = sources
    got = by_id(velocity_sql(items, orders, REF))
    one = got[1]
    assert set(got) == {1, 2}
    assert (one["avg_daily_demand_30d"], one["avg_daily_demand_60d"], one["avg_daily_demand_90d"]) == (
        6 / 30,
        9 / 60,
        9 / 90,
    )
    assert (one["revenue_30d"], one["revenue_90d"], one["active_selling_days"]) == (60, 90, 2)
    assert (one["demand_std_dev"], one["demand_variance"]) == (1.5, 2.25)
    assert (one["min_daily_units"], one["max_daily_units"], one["observation_days"]) == (3, 6, 2)
    # two lines took four days, one took two
    assert one["avg_lead_time_days"] == pytest.approx(10 / 3)


def test_lead_time_sources(sources):
    products, items, orders = sources
    velocity = velocity_sql(items, orders, REF)
    got = {i: r["avg_lead_time_days"] for i, r in by_id(lead_times(products, velocity)).items()}
    assert got == {1: pytest.approx(10 / 3), 2: 4.0, 3: 7.0, 4: 7.0}
    assert {r["avg_lead_time_days"] for r in lead_times(products, velocity, override=3).collect()} == {3.0}
    assert by_id(velocity_sql(items, orders, REF, lead_time_override=0.0))[1]["avg_lead_time_days"] == 0.0


def test_sql_metrics(sources):
    products, items, orders = sources
    got = by_id(reorder_metrics_sql(products, velocity_sql(items, orders, REF), on_zero="null"))
    lead, buffer = 10 / 3, 1.645 * 1.5 * math.sqrt(10 / 3)
    assert got[1]["safety_stock"] == pytest.approx(buffer)
    assert got[1]["reorder_point"] == pytest.approx(0.1 * lead + buffer)
    assert (got[1]["reorder_qty"], got[1]["current_stock"]) == (1, 991.0)
    assert (got[4]["current_stock"], got[4]["avg_lead_time_days"], got[4]["safety_stock"]) == (1000.0, 7.0, 0.0)
    assert got[2]["reorder_qty"] is None


def test_zero_variability_policies(sources):
    products, items, orders = sources
    velocity = velocity_sql(items, orders, REF, lead_time_override=100.0)
    with pytest.raises(Exception, match="division by zero: demand_std_dev"):
        reorder_metrics_sql(products, velocity).collect()
    filled = by_id(reorder_metrics_sql(products, velocity, on_zero="fallback"))
    assert filled[2]["reorder_qty"] == 6  # ceil(5 / 90 * 100)
    assert filled[4]["reorder_qty"] == 1


def test_known_stock_replaces_the_proxy(spark, sources):
    products, items, orders = sources
    stock = spark.createDataFrame([(1, 12.0)], "product_id long, current_stock double")
    got = by_id(reorder_metrics_sql(products, velocity_sql(items, orders, REF), "null", stock=stock))
    assert (got[1]["current_stock"], got[4]["current_stock"]) == (12.0, 1000.0)


def test_negative_lead_time_fails(spark):
    with pytest.raises(Exception, match="negative lead time"):
        spark.range(1).select(lead_root(F.lit(-1.0))).collect()


def test_quantity_is_at_least_one_and_null_stays(spark):
    row = spark.range(1).select(
        reorder_quantity(F.lit(0.0), F.lit(2.0), "error"),
        reorder_quantity(F.lit(7.1), F.lit(2.0), "error"),
        reorder_quantity(F.lit(7.1), F.lit(0.0), "null"),
    ).first()
    assert tuple(row) == (1, 4, None)


def test_runner_velocity_limits_only_the_order_count(sources):
    products, items, orders = sources
    got = by_id(sales_velocity_runner(products, items, orders, REF))
    assert (got[1]["order_count"], got[1]["total_qty_sold"], got[1]["total_revenue"]) == (2, 9, 90)
    assert got[1]["avg_qty_per_order"] == 3.0
    assert got[1]["std_qty_per_order"] == pytest.approx(math.sqrt(2 / 3))
    assert (got[3]["order_count"], got[3]["total_qty_sold"], got[3]["total_revenue"]) == (0, 8, 75)
    assert (got[4]["total_qty_sold"], got[4]["std_qty_per_order"]) == (0, 0.0)
    strict = by_id(sales_velocity_runner(products, items, orders, REF, strict_window=True))
    assert (strict[1]["total_qty_sold"], strict[3]["total_qty_sold"]) == (9, 0)


def test_runner_metrics(sources):
    products, items, orders = sources
    velocity = sales_velocity_runner(products, items, orders, REF)
    got = by_id(reorder_metrics_runner(velocity, on_zero="null"))
    sigma = math.sqrt(2 / 3)
    buffer = math.ceil(1.65 * (sigma / math.sqrt(90)) * math.sqrt(14))
    assert got[1]["safety_stock"] == buffer
    assert got[1]["reorder_point"] == math.ceil(9 / 90 * 14) + buffer
    assert got[1]["reorder_qty"] == math.ceil(9 / 90 * 14 / sigma)
    assert (got[1]["current_stock"], got[2]["reorder_qty"]) == (0, None)
    with pytest.raises(Exception, match="division by zero: demand_std_dev"):
        reorder_metrics_runner(velocity).collect()
    override = by_id(reorder_metrics_runner(velocity, lead_time_override=28.0, on_zero="null"))
    assert override[1]["reorder_point"] > got[1]["reorder_point"]


def test_stage_classes_and_stamp(sources):
    products, items, orders = sources
    got = by_id(reorder_rows(products, items, orders, REF, RUN, on_zero="fallback"))
    assert {i: r["abc_class"] for i, r in got.items()} == {1: "A", 2: "C", 3: "C", 4: "C"}
    assert {r["computed_at"] for r in got.values()} == {RUN}
    assert got[1]["cumulative_revenue_pct"] == pytest.approx(90 / 140)


def test_variance_does_not_depend_on_partitioning(spark, sources):
    _, items, orders = sources
    lines = recent_completed_lines(items, orders, REF)
    seen = {
        tuple(sorted((r["product_id"], r["demand_variance"])
                     for r in sales_velocity(daily_sales(lines).repartition(n), REF).collect()))
        for n in (1, 2, 7)
    }
    assert len(seen) == 1


def test_date_partitions_are_pruned(spark, sources, folder):
    _, items, orders = sources
    path = folder("items")
    items.withColumn("day", F.to_date("created_at")).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    lines = recent_completed_lines(stored, orders, REF, date_partition="day")
    assert sorted(tuple(r) for r in daily_sales(lines).collect()) == sorted(
        tuple(r) for r in daily_sales(recent_completed_lines(items, orders, REF)).collect()
    )
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day#" in plan


def test_strict_window_joins_the_lines_once(spark):
    from checks import tables as t
    from conftest import SMALL

    df = sales_velocity_runner(t.products(spark, SMALL), t.order_lines(spark, SMALL), t.orders(spark, SMALL), t.REFERENCE_DATE, strict_window=True)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 1 and plan.count("l_orderkey") > 0
    assert plan.count("/lineitem.parquet") <= 1 and plan.count("Relation [l_orderkey") == 1
