"""The given parquet tables in the shape the library's contracts expect."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REFERENCE_DATE = dt.date(2001, 8, 2)
RUN_TS = dt.datetime(2001, 8, 2, 2, 0, 0)
PREVIOUS_RUN_TS = dt.datetime(2001, 8, 1, 2, 0, 0)
# The previous run had not yet seen orders updated on or after this date.
LATE_FROM = dt.date(2001, 5, 1)
EVENTS_END = dt.datetime(2024, 1, 31, 0, 0, 0)
MID_MONTH = dt.datetime(2024, 1, 16, 0, 0, 0)
SHORT_DAY = "2024-01-05"


# The files' own schemas, stated so that reading needs no footer scan.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@example.com")).alias("email"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.to_date("o_orderdate")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        placed.alias("order_date"),
        F.date_add(placed, (1 + F.col("o_orderkey") % 14).cast("int")).alias("order_updated_at"),
        F.when(status == "F", "completed").when(status == "O", "open").otherwise("pending").alias("order_status"),
    )


def _hundredths(column: str) -> Column:
    return F.rint(F.col(column) * 100).cast("bigint")


def _decimal(units: Column, scale: int) -> Column:
    """Whole units as an exact decimal, far cheaper than parsing a double."""
    step = F.lit(Decimal(1).scaleb(-scale))
    return (units.cast("decimal(18,0)") * step).cast(f"decimal(18,{scale})")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as stored, without a creation time of their own."""
    cents, percent = _hundredths("l_extendedprice"), _hundredths("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        _decimal(_hundredths("l_quantity"), 2).alias("quantity"),
        _decimal(cents * (100 - percent), 4).alias("line_total"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines created when their order was placed."""
    placed = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("created_at")
    )
    return order_lines(spark, sf_dir).join(placed, "order_id")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


def orders_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging orders; an order without urgency has not been dated yet."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.to_date("o_orderdate")).alias("order_date"),
        (F.col("o_totalprice") / 100).alias("total_amount"),
        F.col("o_orderpriority").alias("priority"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), F.col("ts").alias("event_ts"))


def event_number() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0).cast("int")


def audit_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The events as lines of an audit log, with the columns named in ``keep``."""
    kind = (
        F.when(F.col("event_type") == "view", "event.received")
        .when(F.col("event_type") == "purchase", "pr.created")
        .when(F.col("event_type") == "error", "error.classified")
        .otherwise(F.col("event_type"))
    )
    platform = F.concat(F.lit("p"), (event_number() % 3).cast("string"))
    return events(spark, sf_dir).select(
        *keep,
        F.to_json(
            F.struct(
                kind.alias("event_type"),
                F.col("user_id").cast("string").alias("correlation_id"),
                F.struct(
                    F.struct(platform.alias("platform")).alias("event"),
                    F.least(F.col("value") / 500, F.lit(1.0)).alias("confidence"),
                ).alias("payload"),
            )
        ).alias("value")
    )


def awkward_audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit lines of which some are blank, cut off, arrays, without a platform or with a text confidence.

    By event_id modulo 12: 0 blank, 1 cut off, 2 an array, 3 no platform, 4 a null platform,
    5 the confidence as text, 6 a confidence that is no number, 7 no correlation id.
    """
    kind = F.col("event_id") % 12
    lines = events(spark, sf_dir).select(kind.alias("kind"), F.col("event_id"))
    good = audit_lines(spark, sf_dir, "event_id").join(lines, "event_id")
    value = F.col("value")
    platform = r'"event":\{"platform":"[^"]*"\}'
    return good.select(
        F.when(F.col("kind") == 0, F.lit("  "))
        .when(F.col("kind") == 1, F.substring(value, 1, 20))
        .when(F.col("kind") == 2, F.concat(F.lit("["), value, F.lit("]")))
        .when(F.col("kind") == 3, F.regexp_replace(value, platform, '"event":{}'))
        .when(F.col("kind") == 4, F.regexp_replace(value, platform, '"event":{"platform":null}'))
        .when(F.col("kind") == 5, F.regexp_replace(value, r'"confidence":([^}]*)', '"confidence":"$1"'))
        .when(F.col("kind") == 6, F.regexp_replace(value, r'"confidence":([^}]*)', '"confidence":"high"'))
        .when(F.col("kind") == 7, F.regexp_replace(value, r'"correlation_id":"[^"]*",', ""))
        .otherwise(value)
        .alias("value")
    )


def failure_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as failure signals; costly ones carry artifacts and config."""
    number = event_number()
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "error")
        .select(
            F.concat(F.lit("job_"), F.col("user_id")).alias("job_id"),
            F.concat(F.lit("run_"), F.col("event_id")).alias("run_id"),
            F.concat(F.lit("E"), number).alias("error_signature"),
            F.col("props").alias("log_excerpt"),
            F.when(F.col("value") > 50, F.array("props")).alias("artifacts"),
            F.lit(None).cast("array<string>").alias("code_paths"),
            F.when(F.col("value") > 100, F.create_map(F.lit("k"), number.cast("string"))).alias("config"),
        )
    )
