"""Customer lifetime value from RAW tables to the CUSTOMER_LTV target."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation

from stockwell.functions import run_timestamp
from stockwell.operators.customers import customer_order_stats, recency_features
from stockwell.operators.ltv import ltv_stage, score_runner, score_sql
from stockwell.operators.summary import ltv_facts, run_text
from stockwell.operators.upsert import ACTION, LTV_COMPARE, action_counts, upsert
from stockwell.plans.staging import staged
from stockwell.schemas import CUSTOMER_LTV
from stockwell.sinks.snapshot import SnapshotTable


@dataclass(frozen=True)
class JobResult:
    message: str
    summary: dict
    counts: dict
    quarantined: DataFrame | None = None


def scored_customers(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    reference_date: dt.date,
    profile: str = "sql",
    on_zero: str = "error",
    as_of: bool = False,
) -> DataFrame:
    stats = customer_order_stats(customers, orders, items, reference_date, profile, as_of)
    if profile == "runner":
        return score_runner(stats, reference_date, on_zero)
    return score_sql(recency_features(stats, reference_date), on_zero)


def customer_ltv_job(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    target: SnapshotTable,
    reference_date: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    profile: str = "sql",
    on_zero: str = "error",
    on_null: str = "error",
    as_of: bool = False,
) -> JobResult:
    """Score every customer and merge the result into ``target``.

    The sql profile rewrites only changed rows, the runner profile every
    match. ``on_null="quarantine"`` sets rows aside that the target would
    refuse instead of failing the job: they are written with their reasons in the pass that
    writes the stage, and stay readable after the job without computing anything again.
    """
    reference_date = reference_date or dt.date.today()
    run_ts = run_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    scored = scored_customers(customers, orders, items, reference_date, profile, on_zero, as_of)
    if profile == "sql":
        rows = ltv_stage(scored, run_ts)
    else:
        rows = scored.withColumn("computed_at", run_timestamp(run_ts))
    refuse = on_null == "quarantine"
    stage = staged(rows, CUSTOMER_LTV, "ltv-stage", ltv_facts(), refuse)
    try:
        merged = upsert(
            target.read(),
            stage.loadable.select(*[f.name for f in CUSTOMER_LTV.fields]),
            ["customer_id"],
            compare=LTV_COMPARE if profile == "sql" else None,
            reject_duplicates=True,
        )
        counts = write_counted(merged, target)
        text = run_text("customer_ltv", run_ts, stage.summary, counts)
        return JobResult(text, stage.summary, counts, stage.refused if refuse else None)
    finally:
        stage.drop()


def write_counted(merged: DataFrame, target: SnapshotTable) -> dict:
    """Write a merge result and count its actions in the same pass."""
    seen = Observation()
    target.write(merged.observe(seen, *action_counts()).drop(ACTION))
    return seen.get
