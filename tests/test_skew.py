"""One key holds a third of all rows: joins split, sums combine before the shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockwell.operators.customers import order_revenue
from stockwell.operators.quality import missing_rows
from stockwell.operators.velocity import daily_sales, recent_completed_lines, sales_velocity_runner
from stockwell.streaming.ingest import latest_per_id

REF = dt.date(2024, 6, 30)
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
ROWS = 300_000


@pytest.fixture(scope="module")
def hot(spark):
    """Order 0 has a third of all lines; so has product 0."""
    items = spark.range(0, ROWS, 1, 8).select(
        F.when(F.rand(1) < 0.34, 0).otherwise((F.rand(2) * 20000).cast("long")).alias("order_id"),
        F.when(F.rand(3) < 0.34, 0).otherwise((F.rand(4) * 5000).cast("long")).alias("product_id"),
        (F.rand(5) * 9 + 1).cast("decimal(18,2)").alias("quantity"),
        (F.rand(6) * 99 + 1).cast("decimal(18,4)").alias("line_total"),
        F.lit("2024-06-20").cast("timestamp_ntz").alias("created_at"),
    )
    orders = spark.range(20000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 50).alias("customer_id"),
        F.lit("2024-06-20").cast("date").alias("order_date"),
        F.lit("2024-06-22").cast("date").alias("order_updated_at"),
        F.lit("completed").alias("order_status"),
    )
    products = spark.range(5000).select(
        F.col("id").alias("product_id"),
        F.lit("s").alias("sku"),
        F.lit("n").alias("product_name"),
        F.lit("c").alias("category"),
        F.lit(1).cast("decimal(18,2)").alias("price"),
    )
    path = spark.conf.get("spark.checkpoint.dir") + "/hot-items"
    items.write.parquet(path)
    return spark.read.parquet(path), orders, products


@pytest.fixture
def skewed(spark):
    saved = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    # The adaptive plan of this very DataFrame is final only after it ran.
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split_when_counting_orders(skewed, hot):
    items, orders, products = hot
    assert "skew=true" in final_plan(sales_velocity_runner(products, items, orders, REF))


def test_hot_order_is_split_in_daily_sales(skewed, hot):
    items, orders, _ = hot
    assert "skew=true" in final_plan(daily_sales(recent_completed_lines(items, orders, REF)))


def test_hot_key_is_split_in_the_canary(skewed, hot):
    items, orders, _ = hot
    assert "skew=true" in final_plan(missing_rows(items, orders.filter("order_id > 10"), ["order_id"]))


@pytest.mark.parametrize(
    "build",
    [
        lambda items: order_revenue(items),
        lambda items: latest_per_id(items.select(F.col("product_id").alias("id"), F.col("created_at").alias("event_ts"))),
    ],
)
def test_hot_groups_are_combined_before_the_shuffle(hot, build):
    plan = build(hot[0])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "partial_" in below
