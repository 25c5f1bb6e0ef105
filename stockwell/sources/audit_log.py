"""Audit log in JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.sources.files import path_exists

AUDIT_EVENTS = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)


def parse_audit_lines(lines: DataFrame, column: str = "value", keep_malformed: bool = False) -> DataFrame:
    """Events from text lines; blank, malformed and non-object lines are skipped.

    An absent platform reads ``unknown`` while an explicit null stays NULL. A
    confidence that is no number is NULL. With ``keep_malformed=True`` a broken
    object is a row without event type, which no statistic counts; each line is
    then parsed once instead of once to filter and once to read.
    """
    text = F.btrim(column, F.lit(" \t\n\r\x0b\x0c"))
    doc = F.col("doc")
    platform = F.try_variant_get(doc, "$.payload.event.platform", "variant")
    parsed = (
        lines.select(text.alias("text"))
        .filter(F.startswith("text", F.lit("{")))
        .select(F.try_parse_json("text").alias("doc"))
    )
    events = parsed.select(
        F.when(
            doc.isNotNull(), F.coalesce(F.try_variant_get(doc, "$.event_type", "string"), F.lit(""))
        ).alias("event_type"),
        F.try_variant_get(doc, "$.correlation_id", "string").alias("correlation_id"),
        F.when(platform.isNull(), "unknown")
        .otherwise(F.try_variant_get(doc, "$.payload.event.platform", "string"))
        .alias("platform"),
        F.coalesce(
            F.try_variant_get(doc, "$.payload.confidence", "double"),
            F.try_variant_get(doc, "$.payload.confidence", "string").try_cast("double"),
        ).alias("confidence"),
    )
    return events if keep_malformed else events.filter(F.col("event_type").isNotNull())


def read_audit_log(spark: SparkSession, path: str, keep_malformed: bool = False) -> DataFrame:
    """Events of a log file or folder; a missing path is an empty log."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], AUDIT_EVENTS)
    return parse_audit_lines(spark.read.text(path), keep_malformed=keep_malformed)
