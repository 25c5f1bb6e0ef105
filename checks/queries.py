"""Every operator as a query: ``(spark, sf_dir) -> DataFrame``.

Doubles are rounded for comparison only; the library returns them as computed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import tables as t
from stockwell.operators import audit, customers, quality, sales, signals, summary, velocity
from stockwell.operators.ltv import ltv_ranks, ltv_stage
from stockwell.operators.ranking import Order, abc_classify, cumulative_share, with_orders
from stockwell.operators.reorder import reorder_metrics_runner
from stockwell.operators.upsert import ACTION, LTV_COMPARE, REORDER_COMPARE, upsert, upsert_counts
from stockwell.params import LTV_RUNNER, LTV_SQL
from stockwell.plans.audit_report import audit_report
from stockwell.plans.customer_ltv import customer_ltv_job, scored_customers
from stockwell.plans.daily_sales import daily_sales_job
from stockwell.plans.event_curation import curate_full_append
from stockwell.plans.inventory_reorder import inventory_reorder_job, reorder_rows, velocity_sql
from stockwell.schemas import CUSTOMER_LTV, EVENTS, INVENTORY_REORDER_PLAN, conform
from stockwell.session import materialized, new_folder
from stockwell.sinks.buckets import BucketedTable
from stockwell.sinks.snapshot import SnapshotTable
from stockwell.sinks.writers import append, append_batch, batch_rows, typed_batch, write_json_documents
from stockwell.sources import landing
from stockwell.sources.audit_log import parse_audit_lines
from stockwell.sources.changes import CHANGE, IS_UPDATE, ChangeStream, table_changes
from stockwell.sources.tables import colocated
from stockwell.streaming import gates, ingest

REF, RUN_TS = t.REFERENCE_DATE, t.RUN_TS
RATIOS = {
    "retention_factor",
    "churn_risk_score",
    "frequency_score",
    "ltv_pct_rank",
    "revenue_pct_rank",
    "cumulative_revenue_pct",
}
# Quotients of exact sums: equal to the last bit, so they need no rounding.
QUOTIENTS = {
    "avg_order_value",
    "avg_days_between_orders",
    "avg_monthly_revenue",
    "avg_daily_demand_30d",
    "avg_daily_demand_60d",
    "avg_daily_demand_90d",
    "avg_lead_time_days",
    "avg_qty_per_order",
}
LTV_COLUMNS = [f.name for f in CUSTOMER_LTV.fields]
REORDER_COLUMNS = [f.name for f in INVENTORY_REORDER_PLAN.fields]


def tidy(df: DataFrame) -> DataFrame:
    """Decimals as doubles, ratios to six places and other doubles to four."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            value = value.cast("double")
            if field.name not in QUOTIENTS:
                value = F.round(value, 6 if field.name in RATIOS else 4)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _sources(spark, sf):
    return t.customers(spark, sf), t.orders(spark, sf), t.order_lines(spark, sf)


# Customer lifetime value --------------------------------------------------


def completed_orders(spark, sf):
    return customers.completed_orders(t.orders(spark, sf))


def order_revenue(spark, sf):
    return tidy(customers.order_revenue(t.order_lines(spark, sf)))


def customer_stats_sql(spark, sf):
    return tidy(customers.customer_order_stats(*_sources(spark, sf), REF, "sql"))


def customer_stats_runner(spark, sf):
    return tidy(customers.customer_order_stats(*_sources(spark, sf), REF, "runner"))


def recency_features(spark, sf):
    stats = customers.customer_order_stats(*_sources(spark, sf), REF, "sql")
    return tidy(
        customers.recency_features(stats, REF).select(
            "customer_id", "days_since_last_order", "tenure_months", "avg_days_between_orders"
        )
    )


def _scored(spark, sf, profile="sql", orders=None):
    people, all_orders, items = _sources(spark, sf)
    return scored_customers(people, all_orders if orders is None else orders, items, REF, profile, "null")


def ltv_sql(spark, sf):
    return tidy(_scored(spark, sf).select(*LTV_COLUMNS[:-1]))


def ltv_runner(spark, sf):
    return tidy(_scored(spark, sf, "runner").select(*LTV_COLUMNS[:-1]))


def ltv_rank_columns(spark, sf):
    scored = _scored(spark, sf).select("customer_id", "ltv_score", "total_revenue")
    return tidy(
        ltv_ranks(scored).select("customer_id", "ltv_pct_rank", "revenue_pct_rank", "ltv_global_rank")
    )


def ltv_stage_rows(spark, sf):
    return tidy(ltv_stage(_scored(spark, sf), RUN_TS))


def ltv_summary(spark, sf):
    return tidy(summary.ltv_summary(_scored(spark, sf)))


# Inventory reorder --------------------------------------------------------


def _lines(spark, sf):
    return velocity.recent_completed_lines(t.order_items(spark, sf), t.orders(spark, sf), REF)


def daily_sales(spark, sf):
    return tidy(velocity.daily_sales(_lines(spark, sf)).select("product_id", "sale_date", "units_sold", "revenue"))


def _velocity(spark, sf, override=None):
    return velocity_sql(t.order_items(spark, sf), t.orders(spark, sf), REF, override)


def velocity_windows(spark, sf):
    return tidy(
        _velocity(spark, sf).select(
            "product_id",
            "avg_daily_demand_30d",
            "avg_daily_demand_60d",
            "avg_daily_demand_90d",
            "revenue_30d",
            "revenue_90d",
            "active_selling_days",
        )
    )


def demand_variability(spark, sf):
    return tidy(
        _velocity(spark, sf).select(
            "product_id",
            "demand_std_dev",
            "demand_variance",
            "min_daily_units",
            "max_daily_units",
            "observation_days",
        )
    )


def lead_times(spark, sf):
    return tidy(velocity.lead_times(t.products(spark, sf), _velocity(spark, sf)))


def lead_time_override(spark, sf):
    return tidy(_velocity(spark, sf, override=10.0).select(*velocity.VELOCITY_COLUMNS))


def _reorder(spark, sf, profile="sql", orders=None, override=None):
    return reorder_rows(
        t.products(spark, sf),
        t.order_items(spark, sf) if profile == "sql" else t.order_lines(spark, sf),
        t.orders(spark, sf) if orders is None else orders,
        REF,
        RUN_TS,
        profile,
        override,
        on_zero="fallback",
    )


def reorder_sql(spark, sf):
    return tidy(_reorder(spark, sf))


def reorder_sql_override(spark, sf):
    return tidy(_reorder(spark, sf, override=10.0).select(*REORDER_COLUMNS))


def _velocity_runner(spark, sf, strict=False):
    return velocity.sales_velocity_runner(
        t.products(spark, sf), t.order_lines(spark, sf), t.orders(spark, sf), REF, strict_window=strict
    )


def velocity_runner(spark, sf):
    return tidy(_velocity_runner(spark, sf))


def velocity_runner_strict(spark, sf):
    return tidy(_velocity_runner(spark, sf, strict=True))


def reorder_runner(spark, sf):
    return tidy(_reorder(spark, sf, "runner"))


def reorder_runner_null(spark, sf):
    metrics = reorder_metrics_runner(_velocity_runner(spark, sf), on_zero="null")
    return tidy(
        metrics.select(
            "product_id", F.col("reorder_qty").cast("double"), "reorder_point", "safety_stock"
        )
    )


def abc_classes(spark, sf):
    demand = t.products(spark, sf).select("product_id").join(
        _velocity(spark, sf).select("product_id", "revenue_90d"), "product_id", "left"
    )
    filled = demand.withColumn("revenue_90d", F.coalesce("revenue_90d", F.lit(0)))
    return tidy(abc_classify(filled, "revenue_90d", "product_id"))


def cumulative_revenue(spark, sf):
    revenue = t.order_lines(spark, sf).groupBy("product_id").agg(F.sum("line_total").alias("revenue"))
    return tidy(cumulative_share(revenue, "revenue", "product_id"))


def reorder_summary(spark, sf):
    return summary.reorder_summary(_reorder(spark, sf))


# Upserts ------------------------------------------------------------------


def _previous_orders(spark, sf):
    return t.orders(spark, sf).filter(F.col("order_updated_at") < F.lit(t.LATE_FROM))


def _stamp(df, moment):
    return df.withColumn("computed_at", F.lit(str(moment)).cast("timestamp_ntz"))


def _quotable(scored):
    """Scores the target accepts: customers without any priced line are set aside."""
    return scored.filter(F.col("ltv_score").isNotNull())


def _ltv_target(spark, sf, profile="sql"):
    rows = _quotable(materialized(_scored(spark, sf, profile, _previous_orders(spark, sf)), "scores"))
    return conform(_stamp(rows, t.PREVIOUS_RUN_TS), CUSTOMER_LTV)


def _ltv_source(spark, sf, profile="sql"):
    return _stamp(_scored(spark, sf, profile), RUN_TS).select(*LTV_COLUMNS)


def _merge_quotable(target, source, **options):
    """The merge of the scores the target accepts, and a row of action ``refused`` for each other one.

    The source is written once, as the job's stage is, and read for both.
    """
    source = materialized(source, "scores")
    merged = upsert(target, _quotable(source), ["customer_id"], **options)
    refused = conform(source.filter(F.col("ltv_score").isNull()), CUSTOMER_LTV)
    return merged.unionByName(refused.withColumn(ACTION, F.lit("refused")))


def _merged_ltv(spark, sf):
    return _merge_quotable(_ltv_target(spark, sf), _ltv_source(spark, sf), compare=LTV_COMPARE)


def _named(merged):
    return tidy(merged.withColumnRenamed(ACTION, "action"))


def upsert_ltv(spark, sf):
    return _named(_merged_ltv(spark, sf))


def upsert_counts_ltv(spark, sf):
    return upsert_counts(_merged_ltv(spark, sf))


def upsert_ltv_unconditional(spark, sf):
    return _named(_merge_quotable(_ltv_target(spark, sf, "runner"), _ltv_source(spark, sf, "runner")))


def _reorder_target(spark, sf, profile="sql"):
    rows = _reorder(spark, sf, profile, _previous_orders(spark, sf))
    return conform(_stamp(rows, t.PREVIOUS_RUN_TS), INVENTORY_REORDER_PLAN)


def upsert_reorder(spark, sf):
    return _named(
        upsert(
            _reorder_target(spark, sf),
            _reorder(spark, sf).select(*REORDER_COLUMNS),
            ["product_id"],
            compare=REORDER_COMPARE,
            cast_before_compare=True,
        )
    )


def upsert_reorder_unconditional(spark, sf):
    """Every match is rewritten but for its sku: some targets still have an older one."""
    older = F.when(F.col("product_id") % 5 == 0, F.concat(F.lit("OLD-"), "sku")).otherwise(F.col("sku"))
    target = _reorder_target(spark, sf, "runner").withColumn("sku", older)
    rewritten = [c for c in REORDER_COLUMNS if c not in ("product_id", "sku")]
    return _named(upsert(target, _reorder(spark, sf, "runner"), ["product_id"], update=rewritten))


# Whole jobs ---------------------------------------------------------------


def customer_ltv_job_twice(spark, sf):
    """State of the target after the previous and then the current run."""
    people, orders, items = _sources(spark, sf)
    target = SnapshotTable(spark, new_folder(spark, "customer-ltv"), CUSTOMER_LTV).ensure()
    for seen, moment in ((_previous_orders(spark, sf), t.PREVIOUS_RUN_TS), (orders, RUN_TS)):
        customer_ltv_job(
            people, seen, items, target, REF, moment, on_zero="fallback", on_null="quarantine"
        )
    return tidy(target.read())


def inventory_reorder_job_twice(spark, sf):
    target = SnapshotTable(spark, new_folder(spark, "reorder-plan"), INVENTORY_REORDER_PLAN).ensure()
    for seen, moment in (
        (_previous_orders(spark, sf), t.PREVIOUS_RUN_TS),
        (t.orders(spark, sf), RUN_TS),
    ):
        inventory_reorder_job(
            t.products(spark, sf),
            t.order_items(spark, sf),
            seen,
            target,
            REF,
            moment,
            on_zero="fallback",
            cast_before_compare=True,
        )
    return tidy(target.read())


# Sales, audit, signals ----------------------------------------------------


def sales_validate(spark, sf):
    return sales.validation_counts(t.orders_staging(spark, sf))


def sales_tier(spark, sf):
    return tidy(sales.tier_orders(sales.clean_orders(t.orders_staging(spark, sf)), REF))


def sales_fact(spark, sf):
    """The fact table after one run of the daily job."""
    fact = new_folder(spark, "sales-fact")
    daily_sales_job(t.orders_staging(spark, sf), fact, REF)
    return tidy(spark.read.parquet(fact))


def _audit_events(spark, sf):
    return parse_audit_lines(t.audit_lines(spark, sf), keep_malformed=True)


def audit_stats(spark, sf):
    return audit.audit_stats(_audit_events(spark, sf))


def platform_breakdown(spark, sf):
    return audit.platform_breakdown(_audit_events(spark, sf))


def _normalized(spark, sf):
    return signals.normalize_signals(t.failure_signals(spark, sf), "warehouse", RUN_TS)


def _signal_columns(df):
    return df.select(
        "platform",
        "job_id",
        "run_id",
        "timestamp",
        "error_signature",
        "log_excerpt",
        F.size("artifacts").alias("artifact_count"),
        F.size("code_paths").alias("code_path_count"),
        F.size("config").alias("config_count"),
    )


def signals_normalized(spark, sf):
    return _signal_columns(_normalized(spark, sf))


def signal_documents(spark, sf):
    """Normalised signals written as JSON documents and read back."""
    path = new_folder(spark, "signals")
    df = _normalized(spark, sf)
    write_json_documents(df, path)
    return _signal_columns(spark.read.schema(df.schema).json(path))


# Ingest and streaming -----------------------------------------------------

TEXT_TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _write_lines(df: DataFrame, path: str, header: str, line) -> str:
    """Deliver text lines below one header line per file."""
    (
        df.select(line.alias(header))
        .write.options(header="true", sep="\u0001", quote="\u0000", escape="\u0000")
        .csv(path)
    )
    return path


def _good_line(sep=","):
    return F.concat_ws(sep, F.col("event_id").cast("string"), F.date_format("ts", TEXT_TS))


def _delivered(spark, sf):
    return _write_lines(t.events(spark, sf), new_folder(spark, "landing"), "id,event_ts", _good_line())


def csv_load(spark, sf):
    raw, state = new_folder(spark, "raw"), new_folder(spark, "state")
    ingest.load_landing(spark, _delivered(spark, sf), raw, state)
    return ingest.raw_rows(spark, raw)


def json_load(spark, sf):
    path, raw = new_folder(spark, "landing"), new_folder(spark, "raw")
    write_json_documents(
        t.events(spark, sf).select(
            F.col("event_id").alias("id"), F.date_format("ts", TEXT_TS).alias("event_ts")
        ),
        path,
    )
    ingest.load_landing(spark, path, raw, new_folder(spark, "state"), file_format="json")
    return ingest.raw_rows(spark, raw)


def curated_append(spark, sf):
    """Two full appends: every RAW row is there twice."""
    raw, curated = new_folder(spark, "raw"), new_folder(spark, "curated")
    append(t.events(spark, sf).withColumnsRenamed({"event_id": "id", "ts": "event_ts"}), raw)
    for _ in range(2):
        curate_full_append(spark, raw, curated)
    return spark.read.parquet(curated)


def stream_append(spark, sf):
    """RAW grows between two runs; each row is appended once."""
    raw, curated, state = (new_folder(spark, n) for n in ("raw", "curated", "state"))
    rows = t.raw_events(spark, sf)
    for part in (F.col("event_ts") < F.lit(t.MID_MONTH), F.col("event_ts") >= F.lit(t.MID_MONTH)):
        append(rows.filter(part), raw)
        ingest.curate_append(spark, raw, curated, state)
    return spark.read.schema(EVENTS).parquet(curated)


def stream_merge(spark, sf):
    """Latest event per user, merged in two runs."""
    raw, state = new_folder(spark, "raw"), new_folder(spark, "state")
    curated = SnapshotTable(spark, new_folder(spark, "curated"), EVENTS).ensure()
    rows = t.events(spark, sf).select(F.col("user_id").alias("id"), F.col("ts").alias("event_ts"))
    for part in (F.col("event_ts") >= F.lit(t.MID_MONTH), F.col("event_ts") < F.lit(t.MID_MONTH)):
        append(rows.filter(part), raw)
        ingest.curate_merge(spark, raw, curated, state)
    return curated.read()


def _early_events(spark, sf):
    """An older state of RAW: fewer events, and views not yet to the hour."""
    return (
        t.events(spark, sf)
        .filter(F.col("ts") < F.lit(t.MID_MONTH))
        .select(F.col("event_id").alias("id"), F.col("ts").alias("event_ts"))
    )


def _late_events(spark, sf):
    """A newer state: signups are gone, views moved to the start of their day."""
    moved = F.when(F.col("event_type") == "view", F.to_date("ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    return (
        t.events(spark, sf)
        .filter(F.col("event_type") != "signup")
        .select(F.col("event_id").alias("id"), moved.alias("event_ts"))
    )


def change_feed(spark, sf):
    return table_changes(_early_events(spark, sf), _late_events(spark, sf), ["id"])


# Quality ------------------------------------------------------------------


def quarantine_csv(spark, sf):
    """Four kinds of broken lines among good ones."""
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", _good_line(";"))
        .when(kind == "signup", F.concat(_good_line(), F.lit(",extra")))
        .when(kind == "click", F.concat(F.lit("x"), _good_line()))
        .when(kind == "view", F.col("event_id").cast("string"))
        .otherwise(_good_line())
    )
    path = _write_lines(t.events(spark, sf), new_folder(spark, "landing"), "id,event_ts", line)
    raw = new_folder(spark, "raw")
    ingest.load_landing(spark, path, raw, new_folder(spark, "state"))
    good = ingest.raw_rows(spark, raw).select(
        F.concat_ws(",", F.col("id").cast("string"), F.date_format("event_ts", TEXT_TS)).alias("line"),
        F.lit("loaded").alias("outcome"),
        F.lit("").alias("errors"),
    )
    bad = ingest.quarantine_rows(spark, raw).select(
        F.col(landing.LINE).alias("line"),
        F.lit("quarantined").alias("outcome"),
        F.concat_ws("+", landing.ERRORS).alias("errors"),
    )
    return good.unionByName(bad)


def csv_detected(spark, sf):
    """Deliveries under three delimiters, each loaded under its own."""
    root = new_folder(spark, "landing")
    rows = t.events(spark, sf)
    for sep, kinds in ((",", ["view", "click"]), (";", ["error"]), ("|", ["signup", "purchase"])):
        name = {",": "comma", ";": "semicolon", "|": "bar"}[sep]
        _write_lines(
            rows.filter(F.col("event_type").isin(kinds)), f"{root}/{name}", f"id{sep}event_ts", _good_line(sep)
        )
    return landing.loadable(landing.read_csv_detected(spark, f"{root}/*", EVENTS))


def schema_evolution(spark, sf):
    """A later delivery brings a new column."""
    root = new_folder(spark, "landing")
    rows = t.events(spark, sf)
    early = rows.filter(F.col("ts") < F.lit(t.MID_MONTH))
    late = rows.filter(F.col("ts") >= F.lit(t.MID_MONTH))
    _write_lines(early, f"{root}/early", "id,event_ts", _good_line())
    _write_lines(
        late, f"{root}/late", "id,event_ts,source", F.concat_ws(",", _good_line(), F.col("event_type"))
    )
    return landing.loadable(landing.read_csv_evolving(spark, f"{root}/*", EVENTS))


def canary_missing(spark, sf):
    """A chain that skipped errors: the rows that never arrived."""
    rows = t.events(spark, sf)
    arrived = rows.filter(F.col("event_type") != "error").select(F.col("event_id").alias("id"))
    return quality.missing_rows(t.raw_events(spark, sf), arrived, ["id"])


def canary_counts(spark, sf):
    rows = t.events(spark, sf)
    arrived = rows.filter(F.col("event_type") != "error").select(F.col("event_id").alias("id"))
    return quality.canary(t.raw_events(spark, sf), arrived, ["id"])


def skipped_updates(spark, sf):
    """Users whose newest event is not the newest curated one."""
    rows = t.events(spark, sf).select(F.col("user_id").alias("id"), F.col("ts").alias("event_ts"), "event_type")
    return quality.skipped_updates(rows, rows.filter(F.col("event_type") != "error"))


def safe_cast(spark, sf):
    """Text columns to numbers; some hold words."""
    text = t.events(spark, sf).select(
        "event_id",
        F.when(F.col("event_type") == "click", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(F.col("event_type") == "error", F.lit("?"))
        .otherwise(F.regexp_extract("props", "[0-9]+", 0))
        .alias("number"),
    )
    cast = quality.safe_cast(text, {"amount": "double", "number": "int"})
    return cast.select(
        "event_id",
        F.coalesce("amount", F.lit(-1.0)).alias("amount"),
        F.coalesce("number", F.lit(-1)).alias("number"),
        F.concat_ws("+", quality.ERRORS).alias("errors"),
    )


def stream_lag(spark, sf):
    raw = t.raw_events(spark, sf)
    curated = raw.filter(F.col("event_ts") < F.lit(t.MID_MONTH))
    return quality.stream_lag(raw, curated, max_lag_seconds=3600)


def completeness(spark, sf):
    """Days announced by all events against days delivered without errors' rows."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("file_name")
    rows = t.events(spark, sf)
    manifest = rows.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))
    delivered = rows.filter((F.col("event_type") != "error") | (F.col("ts") < F.lit(t.MID_MONTH))).select(day)
    return quality.completeness(manifest, delivered)


def freshness_guard(spark, sf):
    return quality.freshness(t.raw_events(spark, sf), t.EVENTS_END + dt.timedelta(days=2), 86400)


# Merges, streams and gates over stored state -------------------------------


def _latest(spark, sf, rows=None):
    """Newest event by user; every tenth user has no id."""
    rows = t.events(spark, sf) if rows is None else rows
    user = F.when(F.col("user_id") % 10 != 0, F.col("user_id"))
    return rows.select(user.alias("id"), F.col("ts").alias("event_ts"))


def merge_buckets(spark, sf):
    """Newest event per user, NULL among them, merged by bucket in two runs, and all of it replayed."""
    raw = new_folder(spark, "raw")
    table = BucketedTable(spark, new_folder(spark, "curated"), EVENTS, ["id"], buckets=16).ensure()
    rows = _latest(spark, sf)
    state = new_folder(spark, "state")
    for part in (F.col("event_ts") >= F.lit(t.MID_MONTH), F.col("event_ts") < F.lit(t.MID_MONTH)):
        append(rows.filter(part), raw)
        ingest.curate_merge(spark, raw, table, state)
    ingest.curate_merge(spark, raw, table, new_folder(spark, "state"))
    return table.read()


def change_stream(spark, sf):
    """Three pulls: what was inserted, what was updated, what was deleted."""
    table = BucketedTable(spark, new_folder(spark, "curated"), EVENTS, ["id"], buckets=16).ensure()
    stream, sink = ChangeStream(table, new_folder(spark, "position")), new_folder(spark, "changes")
    early = t.events(spark, sf).filter(F.col("ts") < F.lit(t.MID_MONTH))

    def keep(changes, number):
        append_batch(changes, sink, "changes", number)

    table.merge(ingest.latest_per_id(_latest(spark, sf, early)))
    stream.pull(keep)
    table.merge(ingest.latest_per_id(_latest(spark, sf)), newer_by="event_ts")
    stream.pull(keep)
    gone = table.read().where(F.col("id") % 7 == 0).withColumn("gone", F.lit(True))
    table.merge(gone, deleted="gone")
    stream.pull(keep)
    stream.pull(keep)
    marks = [T.StructField(CHANGE, T.StringType()), T.StructField(IS_UPDATE, T.BooleanType()), T.StructField("_batch", T.IntegerType())]
    marks = T.StructType(EVENTS.fields + marks)
    return spark.read.schema(marks).parquet(f"{sink}/_writer=changes").withColumnRenamed("_batch", "pull")


def shared_curated(spark, sf):
    """One CURATED table of a batch job and a stream; every batch and the stream's start repeated."""
    raw, curated, state = (new_folder(spark, n) for n in ("raw", "curated", "state"))
    rows, kind = t.events(spark, sf), F.col("event_type")
    events = [F.col("event_id").alias("id"), F.col("ts").alias("event_ts")]
    append(rows.filter(~kind.isin("view", "error")).select(events), raw)
    for _ in range(2):
        append_batch(rows.filter(kind == "view").select(events), curated, "backfill", "views")
        ingest.curate_append(spark, raw, curated, state, writer="stream")
        append_batch(rows.filter(kind == "error").select(events), curated, "backfill", "errors")
    ingest.curate_append(spark, raw, curated, new_folder(spark, "state"), writer="stream")
    return batch_rows(spark, curated, EVENTS)


def mixed_load(spark, sf):
    """A stream over files of three delimiters, with columns moved, added and left out, and broken lines."""
    root = new_folder(spark, "landing")
    rows, kind = t.events(spark, sf), F.col("event_type")
    stamp, number = F.date_format("ts", TEXT_TS), F.col("event_id").cast("string")
    layouts = [
        ("plain", ["view"], "id,event_ts", F.concat_ws(",", number, stamp)),
        ("with space (1)", ["click", "signup"], "event_ts;Source;id", F.concat_ws(";", stamp, kind, number)),
        ("bar", ["purchase"], "id|event_ts", F.concat_ws("|", number, stamp, F.when(F.col("event_id") % 5 == 0, "extra"))),
        ("short", ["error"], "id", number),
    ]
    for name, kinds, header, line in layouts:
        _write_lines(rows.filter(kind.isin(kinds)), f"{root}/{name}", header, line)
    raw, bad, state = (new_folder(spark, n) for n in ("raw", "quarantine", "state"))
    for _ in range(2):
        ingest.load_mixed(spark, f"{landing.literal_path(root)}/*", raw, bad, state)
    stored = EVENTS.fields + [T.StructField(landing.EXTRA, T.MapType(T.StringType(), T.StringType()))]
    good = batch_rows(spark, raw, T.StructType(stored)).select(
        "id", "event_ts", F.col(landing.EXTRA)["source"].alias("source"), F.lit("").alias("line")
    )
    kept = T.StructType([T.StructField(landing.LINE, T.StringType())])
    lines = batch_rows(spark, bad, kept).select(
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("timestamp_ntz").alias("event_ts"), F.lit("quarantined").alias("source"),
        F.col(landing.LINE).alias("line"),
    )
    return good.unionByName(lines)


def gated_load(spark, sf):
    """Events delivered by day, one day short at first: what each of two runs reports and has loaded."""
    root, raw, bad = (new_folder(spark, n) for n in ("landing", "raw", "quarantine"))
    rows = t.events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    manifest = rows.groupBy(F.col("day").alias("delivery")).agg(F.count(F.lit(1)).alias("row_count"))
    lines = rows.select("day", "event_type", _good_line().alias("id,event_ts"))
    csv = {"header": "true", "sep": "\u0001", "quote": "\u0000", "escape": "\u0000"}
    late = (F.col("day") == t.SHORT_DAY) & (F.col("event_type") == "error")
    lines.filter(~late).drop("event_type").write.options(**csv).partitionBy("day").csv(root)
    found = []
    for run in (1, 2):
        report = gates.load_when_complete(spark, root, manifest.withColumn("delivery", F.concat(F.lit("day="), "delivery")), raw, bad)
        short = report.select(F.lit(run).alias("run"), F.lit("short").alias("outcome"), "delivery", F.col("delivered_rows").alias("rows"))
        full = spark.read.parquet(raw).groupBy(F.col("_batch").alias("delivery")).agg(F.count("id").alias("rows"))
        loaded = full.select(F.lit(run).alias("run"), F.lit("loaded").alias("outcome"), "delivery", "rows")
        found.append(materialized(short.union(loaded), "gated"))
        if run == 1:
            lines.filter(late).drop("event_type").write.mode("append").options(**csv).partitionBy("day").csv(root)
    return found[0].union(found[1])


def lag_gate(spark, sf):
    """CURATED is run until it has caught up, while RAW grows during the first try and between two calls."""
    raw, curated, state = (new_folder(spark, n) for n in ("raw", "curated", "state"))
    rows = t.raw_events(spark, sf)
    day = F.to_date("event_ts")
    parts = [day < "2024-01-10", (day >= "2024-01-10") & (day < "2024-01-20"), day >= "2024-01-20"]
    append(rows.filter(parts[0]), raw)
    waiting = [parts[1]]

    def growing():
        if waiting:
            append(rows.filter(waiting.pop()), raw)
            # The first try is measured against a RAW that is further on than it can see.
            return "2024-01-25 00:00:00"
        return gates.newest_mark(spark, raw)

    seen = []
    for call, newest in ((1, growing), (2, None)):
        for row in gates.curate_until_fresh(spark, raw, curated, state, "stream", 60, newest_raw=newest):
            seen.append((call, row["rows"], row["curated_ts"] == row["raw_ts"]))
        if call == 1:
            append(rows.filter(parts[2]), raw)
    report = spark.createDataFrame(seen, "call int, rows long, caught_up boolean")
    total = batch_rows(spark, curated, EVENTS).agg(F.count("id").alias("curated_rows"))
    return report.groupBy("call").agg(F.sum("rows").alias("rows"), F.max("caught_up").alias("caught_up")).join(F.broadcast(total))


ORDER_BUCKETS = 32


def _colocated(spark, sf):
    """Orders and their lines, stored side by side by order."""
    lines = colocated(t.order_items(spark, sf), new_folder(spark, "lines"), "order_id", ORDER_BUCKETS)
    orders = colocated(t.orders(spark, sf), new_folder(spark, "orders"), "order_id", ORDER_BUCKETS)
    return lines, orders


def daily_sales_colocated(spark, sf):
    lines, orders = _colocated(spark, sf)
    sales_by_day = velocity.daily_sales(velocity.recent_completed_lines(lines, orders, REF))
    return tidy(sales_by_day.select("product_id", "sale_date", "units_sold", "revenue"))


def customer_stats_colocated(spark, sf):
    lines, orders = _colocated(spark, sf)
    return tidy(customers.customer_order_stats(t.customers(spark, sf), orders, lines, REF, "sql"))


def freshness_mark(spark, sf):
    """The guard's row from the mark that the load left, without a read of RAW."""
    raw = new_folder(spark, "raw")
    ingest.load_landing(spark, _delivered(spark, sf), raw, new_folder(spark, "state"))
    return gates.marked_freshness(spark, raw, t.EVENTS_END + dt.timedelta(days=2), 86400)


def ltv_refused(spark, sf):
    """Customers that the job set aside, with the reasons, read after it is over."""
    people, orders, items = _sources(spark, sf)
    target = SnapshotTable(spark, new_folder(spark, "customer-ltv"), CUSTOMER_LTV).ensure()
    done = customer_ltv_job(people, orders, items, target, REF, RUN_TS, on_zero="null", on_null="quarantine")
    return done.quarantined.select("customer_id", "order_count", F.concat_ws("+", "_reasons").alias("reasons"))


def _audit_folder(spark, sf):
    """The audit log as files, with blank, malformed, unnamed and text-valued lines among the good ones."""
    path = new_folder(spark, "audit")
    t.awkward_audit_lines(spark, sf).write.text(path)
    return path


def audit_report_stats(spark, sf):
    return audit_report(spark, _audit_folder(spark, sf)).stats


def audit_report_platforms(spark, sf):
    report = audit_report(spark, _audit_folder(spark, sf)).platforms
    return report.select(F.coalesce("platform", F.lit("(null)")).alias("platform"), "incidents")


def typed_batch_events(spark, sf):
    """Texts cast to a contract and read by their name in SQL."""
    texts = t.events(spark, sf).select(F.col("event_id").cast("string").alias("id"), F.date_format("ts", TEXT_TS).alias("event_ts"))
    typed_batch(texts, EVENTS, "typed_events")
    return spark.sql("SELECT to_date(event_ts) AS day, count(id) AS events, max(id) AS last_id FROM typed_events GROUP BY ALL")


def revenue_order(spark, sf):
    """The order in which customers are shown, as positions."""
    stats = customers.customer_order_stats(*_sources(spark, sf), REF, "sql")
    return with_orders(
        stats.select("customer_id", "total_revenue"),
        Order("total_revenue", "customer_id", descending=True, row_number="position"),
    ).select("customer_id", "position")


def run_facts(spark, sf):
    """The facts of the job's log line, read back from its JSON."""
    people, orders, items = _sources(spark, sf)
    target = SnapshotTable(spark, new_folder(spark, "customer-ltv"), CUSTOMER_LTV).ensure()
    done = customer_ltv_job(people, orders, items, target, REF, RUN_TS, on_zero="fallback", on_null="quarantine")
    line = spark.createDataFrame([(done.message.split(" ", 2)[2],)], "facts string")
    names = ["customer_count", "platinum_count", "gold_count", "silver_count", "bronze_count", "rows_inserted", "rows_updated"]
    return line.select(*[F.get_json_object("facts", f"$.{n}").cast("long").alias(n) for n in names])


def all_queries() -> dict:
    return {
        "completed_orders": completed_orders,
        "order_revenue": order_revenue,
        "customer_stats_sql": customer_stats_sql,
        "customer_stats_runner": customer_stats_runner,
        "recency_features": recency_features,
        "ltv_sql": ltv_sql,
        "ltv_runner": ltv_runner,
        "ltv_ranks": ltv_rank_columns,
        "ltv_stage": ltv_stage_rows,
        "ltv_summary": ltv_summary,
        "daily_sales": daily_sales,
        "velocity_windows": velocity_windows,
        "demand_variability": demand_variability,
        "lead_times": lead_times,
        "lead_time_override": lead_time_override,
        "reorder_sql": reorder_sql,
        "reorder_sql_override": reorder_sql_override,
        "velocity_runner": velocity_runner,
        "velocity_runner_strict": velocity_runner_strict,
        "reorder_runner": reorder_runner,
        "reorder_runner_null": reorder_runner_null,
        "abc_classify": abc_classes,
        "cumulative_share": cumulative_revenue,
        "reorder_summary": reorder_summary,
        "upsert_ltv": upsert_ltv,
        "upsert_ltv_unconditional": upsert_ltv_unconditional,
        "upsert_reorder": upsert_reorder,
        "upsert_reorder_unconditional": upsert_reorder_unconditional,
        "upsert_counts": upsert_counts_ltv,
        "customer_ltv_job": customer_ltv_job_twice,
        "inventory_reorder_job": inventory_reorder_job_twice,
        "sales_validate": sales_validate,
        "sales_tier": sales_tier,
        "sales_fact": sales_fact,
        "audit_stats": audit_stats,
        "platform_breakdown": platform_breakdown,
        "signals_normalized": signals_normalized,
        "signal_documents": signal_documents,
        "csv_load": csv_load,
        "json_load": json_load,
        "curated_append": curated_append,
        "stream_append": stream_append,
        "stream_merge": stream_merge,
        "change_feed": change_feed,
        "quarantine_csv": quarantine_csv,
        "csv_detected": csv_detected,
        "schema_evolution": schema_evolution,
        "canary_missing": canary_missing,
        "canary_counts": canary_counts,
        "skipped_updates": skipped_updates,
        "safe_cast": safe_cast,
        "stream_lag": stream_lag,
        "completeness": completeness,
        "freshness_guard": freshness_guard,
        "merge_buckets": merge_buckets,
        "change_stream": change_stream,
        "shared_curated": shared_curated,
        "mixed_load": mixed_load,
        "gated_load": gated_load,
        "lag_gate": lag_gate,
        "freshness_mark": freshness_mark,
        "daily_sales_colocated": daily_sales_colocated,
        "customer_stats_colocated": customer_stats_colocated,
        "ltv_refused": ltv_refused,
        "audit_report_stats": audit_report_stats,
        "audit_report_platforms": audit_report_platforms,
        "typed_batch": typed_batch_events,
        "revenue_order": revenue_order,
        "run_facts": run_facts,
    }
