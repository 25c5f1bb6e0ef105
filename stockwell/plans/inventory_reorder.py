"""Inventory reorder plan from RAW tables to the INVENTORY_REORDER_PLAN target."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stockwell.operators.reorder import (
    reorder_metrics_runner,
    reorder_metrics_sql,
    reorder_plan_runner,
    reorder_stage,
)
from stockwell.operators.summary import reorder_facts, run_text
from stockwell.operators.upsert import REORDER_COMPARE, upsert
from stockwell.operators.velocity import (
    daily_sales,
    recent_completed_lines,
    sales_velocity,
    sales_velocity_runner,
)
from stockwell.params import REORDER_SQL
from stockwell.plans.customer_ltv import JobResult, write_counted
from stockwell.plans.staging import staged
from stockwell.schemas import INVENTORY_REORDER_PLAN
from stockwell.sinks.snapshot import SnapshotTable


def velocity_sql(
    items: DataFrame,
    orders: DataFrame,
    reference_date: dt.date,
    lead_time_override: float | None = None,
    date_partition: str | None = None,
) -> DataFrame:
    lines = recent_completed_lines(
        items, orders, reference_date, REORDER_SQL.lookback_days, date_partition
    )
    return sales_velocity(daily_sales(lines), reference_date, lead_time_override=lead_time_override)


def reorder_rows(
    products: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reference_date: dt.date,
    run_ts: dt.datetime,
    profile: str = "sql",
    lead_time_override: float | None = None,
    lookback_days: int = 90,
    on_zero: str = "error",
    stock: DataFrame | None = None,
    date_partition: str | None = None,
) -> DataFrame:
    """The stage rows that a job summarises and merges."""
    if profile == "runner":
        velocity = sales_velocity_runner(products, items, orders, reference_date, lookback_days)
        metrics = reorder_metrics_runner(velocity, lookback_days, lead_time_override, on_zero)
        return reorder_plan_runner(metrics, run_ts)
    velocity = velocity_sql(items, orders, reference_date, lead_time_override, date_partition)
    return reorder_stage(reorder_metrics_sql(products, velocity, on_zero, stock=stock), run_ts)


def inventory_reorder_job(
    products: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    target: SnapshotTable,
    reference_date: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    profile: str = "sql",
    lead_time_override: float | None = None,
    lookback_days: int = 90,
    on_zero: str = "error",
    on_null: str = "error",
    stock: DataFrame | None = None,
    cast_before_compare: bool = False,
    date_partition: str | None = None,
) -> JobResult:
    """Plan every product and merge the result into ``target``.

    ``stock`` replaces the stock proxy and ``date_partition`` names the column
    by which order lines are stored per day (both sql profile only).
    """
    reference_date = reference_date or dt.date.today()
    run_ts = run_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None)
    rows = reorder_rows(
        products,
        items,
        orders,
        reference_date,
        run_ts,
        profile,
        lead_time_override,
        lookback_days,
        on_zero,
        stock,
        date_partition,
    )
    refuse = on_null == "quarantine"
    stage = staged(rows, INVENTORY_REORDER_PLAN, "reorder-stage", reorder_facts(), refuse)
    try:
        columns = [f.name for f in INVENTORY_REORDER_PLAN.fields]
        runner = profile == "runner"
        merged = upsert(
            target.read(),
            stage.loadable.select(*columns),
            ["product_id"],
            compare=None if runner else REORDER_COMPARE,
            # The runner never rewrites the sku of a product it already has.
            update=[c for c in columns if c not in ("product_id", "sku")] if runner else None,
            cast_before_compare=cast_before_compare,
            reject_duplicates=True,
        )
        counts = write_counted(merged, target)
        return JobResult(
            run_text("inventory_reorder", run_ts, {"lead_time_override": lead_time_override}, stage.summary, counts),
            stage.summary,
            counts,
            stage.refused if refuse else None,
        )
    finally:
        stage.drop()
