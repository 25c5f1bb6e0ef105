"""Loads that act on their checks: complete deliveries, bounded lag, fresh input."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.operators.quality import with_age
from stockwell.schemas import EVENTS
from stockwell.sinks.marks import mark_newest, newest_mark
from stockwell.sinks.writers import BATCH, WRITER
from stockwell.sources.files import child_names
from stockwell.sources.landing import ERRORS, FILE, LINE, literal_path, plain_file, read_csv
from stockwell.streaming.ingest import curate_append, observations


class LagError(RuntimeError):
    """CURATED stayed too far behind RAW."""


def arrived_rows(spark: SparkSession, landing: str) -> DataFrame:
    """``delivery, delivered_rows`` of the CSV files in ``landing/<delivery>/``, headers not counted."""
    lines = spark.read.text(f"{literal_path(landing)}/*").where(F.trim("value") != "")
    per_file = lines.groupBy(plain_file().alias("file")).agg((F.count(F.lit(1)) - 1).alias("n"))
    delivery = F.element_at(F.split("file", "/"), -2)
    return per_file.groupBy(delivery.alias("delivery")).agg(F.sum("n").alias("delivered_rows"))


def load_when_complete(
    spark: SparkSession,
    landing: str,
    manifest: DataFrame,
    raw: str,
    quarantine: str,
    schema: T.StructType = EVENTS,
    writer: str = "deliveries",
) -> DataFrame:
    """Load every complete delivery that has not been loaded; returns the report of the others.

    ``manifest`` has a row ``delivery, row_count`` for each folder announced below ``landing``. A
    delivery is loaded as a batch under its own name once it has at least as many rows as
    announced, so a late one enters a later run, and a run that is repeated after a
    crash replaces what it had written. The report holds announced deliveries that are short
    of rows: ``delivery, row_count, delivered_rows``.
    """
    counted = manifest.select("delivery", "row_count").join(arrived_rows(spark, landing), "delivery", "left") if child_names(
        spark, landing
    ) else manifest.select("delivery", "row_count", F.lit(0).cast("long").alias("delivered_rows"))
    counted = counted.withColumn("delivered_rows", F.coalesce("delivered_rows", F.lit(0)))
    done = {n.split("=", 1)[1] for n in child_names(spark, f"{raw}/{WRITER}={writer}") if n.startswith(f"{BATCH}=")}
    complete = counted.where(F.col("delivered_rows") >= F.col("row_count")).select("delivery")
    # Names of folders, which the driver lists for any read.
    names = sorted(r["delivery"] for r in complete.collect() if r["delivery"] not in done)
    if names:
        landed = read_csv(spark, [literal_path(f"{landing}/{n}") for n in names], schema)
        named = landed.withColumns(
            {
                WRITER: F.lit(writer),
                BATCH: F.element_at(F.split(F.url_decode(F.replace(F.col(FILE), F.lit("+"), F.lit("%2B"))), "/"), -2),
            }
        )
        # The quarantine first: a batch counts as loaded once it stands in RAW.
        for rows, path in (
            (named.where(F.size(ERRORS) > 0).select(FILE, LINE, ERRORS, WRITER, BATCH), quarantine),
            (named.where(F.size(ERRORS) == 0).drop(ERRORS, LINE, FILE), raw),
        ):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WRITER, BATCH).parquet(path)
    return counted.where(F.col("delivered_rows") < F.col("row_count"))


def curate_until_fresh(
    spark: SparkSession,
    raw: str,
    curated: str,
    checkpoint: str,
    writer: str,
    max_lag_seconds: int,
    tries: int = 3,
    newest_raw: Callable[[], str | None] | None = None,
) -> list[dict]:
    """Run the increment until CURATED is at most ``max_lag_seconds`` behind RAW.

    RAW's newest time is its committed mark (or what ``newest_raw`` says); CURATED's is what the
    stream's own batches observed, kept as a mark too, so no data is read to measure. Returns
    ``try, rows, raw_ts, curated_ts, lag_seconds`` of each try; :class:`LagError` after the last.
    """
    report: list[dict] = []
    for number in range(1, tries + 1):
        raw_ts = newest_raw() if newest_raw else newest_mark(spark, raw)
        seen = observations(curate_append(spark, raw, curated, checkpoint, writer=writer))
        curated_ts = mark_newest(spark, curated, [o["newest_ts"] for o in seen])
        lag = _seconds_between(curated_ts, raw_ts)
        report.append(
            {"try": number, "rows": sum(o["rows"] for o in seen), "raw_ts": raw_ts, "curated_ts": curated_ts, "lag_seconds": lag}
        )
        if lag is not None and lag <= max_lag_seconds:
            return report
    raise LagError(f"{curated} is behind after {tries} tries: {report[-1]}")


def _seconds_between(early: str | None, late: str | None) -> float | None:
    """None if only the late time is known; 0 without a late time."""
    if late is None:
        return 0.0
    if early is None:
        return None
    return (dt.datetime.fromisoformat(late) - dt.datetime.fromisoformat(early)).total_seconds()


def marked_freshness(spark: SparkSession, folder: str, reference: dt.datetime, max_age_seconds: int) -> DataFrame:
    """The row of :func:`freshness` from a folder's committed mark; no data row is read."""
    newest = newest_mark(spark, folder)
    row = spark.createDataFrame([(newest,)], "newest_ts string").select(F.col("newest_ts").cast("timestamp_ntz").alias("newest_ts"))
    return with_age(row, reference, max_age_seconds)
