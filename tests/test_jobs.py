import datetime as dt
import json
from decimal import Decimal

import pytest

from conftest import rows
from stockwell.plans.customer_ltv import customer_ltv_job
from stockwell.plans.inventory_reorder import inventory_reorder_job
from stockwell.schemas import CUSTOMER_LTV, CUSTOMERS, EVENTS, INVENTORY_REORDER_PLAN, ORDER_ITEMS, ORDERS, PRODUCTS
from stockwell.session import shared_folder
from stockwell.sinks.snapshot import SnapshotTable
from stockwell.sinks.writers import append, typed_batch, write_json_documents
from stockwell.sources.tables import scan, scan_or_empty

REF = dt.date(2024, 6, 15)
RUN1, RUN2 = dt.datetime(2024, 6, 15, 2), dt.datetime(2024, 6, 16, 2)
NOW = dt.datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def ltv_sources(spark):
    people = [(i, "a", "b", "c", NOW) for i in (1, 2, 3)]
    orders = [
        (10, 1, dt.date(2024, 1, 10), NOW, "completed"),
        (20, 2, dt.date(2024, 2, 10), NOW, "completed"),
    ]
    items = [(10, 1, Decimal(1), Decimal("3000"), NOW), (20, 1, Decimal(1), Decimal("90"), NOW)]
    return (
        spark.createDataFrame(people, CUSTOMERS),
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(items, ORDER_ITEMS),
    )


def test_ltv_job_merges_and_reports(spark, ltv_sources, folder):
    target = SnapshotTable(spark, folder("ltv"), CUSTOMER_LTV).ensure()
    first = customer_ltv_job(*ltv_sources, target, REF, RUN1)
    assert first.counts == {"rows_inserted": 2, "rows_updated": 0, "rows_merged": 2}
    assert first.summary["customer_count"] == 2 and first.summary["total_revenue"] == 3090.0
    facts = json.loads(first.message.split(" ", 2)[2])
    assert (facts["rows_merged"], facts["rows_inserted"], facts["rows_updated"]) == (2, 2, 0)
    assert [facts[f"{t}_count"] for t in ("platinum", "gold", "silver", "bronze")] == [0, 1, 0, 1]

    again = customer_ltv_job(*ltv_sources, target, REF, RUN2)
    assert again.counts == {"rows_inserted": 0, "rows_updated": 0, "rows_merged": 0}
    assert {r["computed_at"] for r in target.read().collect()} == {RUN1}

    later = customer_ltv_job(*ltv_sources, target, REF + dt.timedelta(days=1), RUN2)
    assert later.counts["rows_updated"] == 2
    assert {r["computed_at"] for r in target.read().collect()} == {RUN2}


def test_runner_job_rewrites_every_match(spark, ltv_sources, folder):
    target = SnapshotTable(spark, folder("ltv"), CUSTOMER_LTV).ensure()
    assert customer_ltv_job(*ltv_sources, target, REF, RUN1, profile="runner").counts["rows_inserted"] == 3
    assert customer_ltv_job(*ltv_sources, target, REF, RUN2, profile="runner").counts["rows_updated"] == 3
    people, orders, items = ltv_sources
    nobody = customer_ltv_job(people.limit(0), orders, items, target, REF, RUN2, profile="runner")
    assert nobody.counts["rows_merged"] == 0


def test_null_score_fails_or_is_set_aside(spark, ltv_sources, folder):
    people, orders, items = ltv_sources
    no_lines = items.filter("order_id = 10")
    target = SnapshotTable(spark, folder("ltv"), CUSTOMER_LTV).ensure()
    with pytest.raises(Exception, match="NULL in required column ltv_score"):
        customer_ltv_job(people, orders, no_lines, target, REF, RUN1)
    assert target.read().count() == 0
    done = customer_ltv_job(people, orders, no_lines, target, REF, RUN1, on_null="quarantine")
    assert [r["customer_id"] for r in target.read().collect()] == [1]
    assert [r["customer_id"] for r in done.quarantined.collect()] == [2]


def test_zero_tenure_stops_the_job_before_any_write(spark, ltv_sources, folder):
    people, orders, items = ltv_sources
    target = SnapshotTable(spark, folder("ltv"), CUSTOMER_LTV).ensure()
    with pytest.raises(Exception, match="division by zero"):
        customer_ltv_job(people, orders, items, target, dt.date(2024, 2, 20), RUN1)
    assert target.versions() == [0]


@pytest.fixture(scope="module")
def reorder_sources(spark):
    products = [(i, f"SKU-{i}", "p", "c", Decimal(1)) for i in (1, 2)]
    orders = [
        (10, 1, dt.date(2024, 6, 1), dt.datetime(2024, 6, 5), "completed"),
        (11, 1, dt.date(2024, 6, 2), dt.datetime(2024, 6, 4), "completed"),
    ]
    items = [
        (10, 1, Decimal(4), Decimal("40"), dt.datetime(2024, 6, 1)),
        (11, 1, Decimal(2), Decimal("20"), dt.datetime(2024, 6, 2)),
    ]
    return (
        spark.createDataFrame(products, PRODUCTS),
        spark.createDataFrame(items, ORDER_ITEMS),
        spark.createDataFrame(orders, ORDERS),
    )


def test_reorder_job(spark, reorder_sources, folder):
    target = SnapshotTable(spark, folder("plan"), INVENTORY_REORDER_PLAN).ensure()
    with pytest.raises(Exception, match="division by zero: demand_std_dev"):
        inventory_reorder_job(*reorder_sources, target, REF, RUN1)
    first = inventory_reorder_job(*reorder_sources, target, REF, RUN1, on_zero="fallback")
    assert first.counts["rows_inserted"] == 2
    facts = json.loads(first.message.split(" ", 2)[2])
    assert facts["lead_time_override"] is None
    # The single selling product crosses both thresholds, so all are lowest.
    assert [facts[f"abc_{c}_count"] for c in "abc"] == [0, 0, 2]
    override = inventory_reorder_job(
        *reorder_sources, target, REF, RUN2, on_zero="fallback", lead_time_override=30.0, cast_before_compare=True
    )
    assert override.counts["rows_updated"] == 1
    assert json.loads(override.message.split(" ", 2)[2])["lead_time_override"] == 30.0


def test_reorder_runner_job_never_rewrites_a_sku(spark, reorder_sources, folder):
    products, items, orders = reorder_sources
    target = SnapshotTable(spark, folder("plan"), INVENTORY_REORDER_PLAN).ensure()
    inventory_reorder_job(*reorder_sources, target, REF, RUN1, profile="runner", on_zero="fallback")
    renamed = products.selectExpr("product_id", "'NEW' AS sku", "product_name", "category", "price")
    again = inventory_reorder_job(renamed, items, orders, target, REF, RUN2, profile="runner", on_zero="fallback")
    assert again.counts["rows_updated"] == 2
    assert {r["sku"] for r in target.read().collect()} == {"SKU-1", "SKU-2"}


def test_snapshot_ignores_unfinished_versions(spark, folder, tmp_path):
    target = SnapshotTable(spark, folder("t"), EVENTS).ensure()
    row = spark.createDataFrame([(1, NOW)], EVENTS)
    assert [target.write(row), target.write(row.unionAll(row)), target.write(row)] == [1, 2, 3]
    (tmp_path / "t" / "version=000000003" / "_SUCCESS").unlink()
    assert target.versions() == [0, 1, 2] and target.read().count() == 2
    target.vacuum(keep=1)
    assert target.versions() == [2]


def test_table_scans_and_writers(spark, folder):
    row = spark.createDataFrame([("1", "2024-01-01 00:00:00", "x")], "id string, event_ts string, extra string")
    append(row, "stockwell_rows")
    append(row, "stockwell_rows")
    assert scan(spark, "stockwell_rows", EVENTS).columns == ["id", "event_ts"]
    assert scan(spark, "stockwell_rows").count() == 2
    assert scan_or_empty(spark, folder("none"), EVENTS).count() == 0
    typed_batch(row, EVENTS, "batch_rows")
    assert [r[0] for r in spark.sql("SELECT id + 1 FROM batch_rows").collect()] == [2]
    write_json_documents(row, folder("docs"))
    assert rows(spark.read.json(folder("docs")).select("id", "extra")) == [("1", "x")]
    append(row, folder("parts"), partition_by="extra")
    assert spark.read.parquet(folder("parts")).filter("extra = 'x'").count() == 1


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("name", ["daily_sales_colocated", "customer_stats_colocated"])
def test_colocated_tables_join_without_moving_a_line(spark, name):
    from checks.queries import all_queries
    from conftest import SMALL

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Join" in plan and "Bucketed: true" in plan
    assert "hashpartitioning(order_id" not in plan
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("stockwell_") and len(x.name) == 42]
