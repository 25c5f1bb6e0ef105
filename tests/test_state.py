"""Bucketed merges, change streams, shared tables, mixed files and gates."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from stockwell.plans.event_curation import curate_full_append
from stockwell.schemas import CUSTOMER_LTV, EVENTS, INVENTORY_REORDER_PLAN, contract_errors, required_not_null
from stockwell.sinks import buckets
from stockwell.sinks.buckets import BucketedTable, TableClaimed
from stockwell.sinks.marks import mark_newest, newest_mark
from stockwell.sinks.snapshot import ConcurrentWrite, SnapshotTable
from stockwell.sinks.writers import append, append_batch, batch_rows
from stockwell.sources import landing
from stockwell.sources.changes import ChangeStream, apply_changes
from stockwell.sources.files import claim_file
from stockwell.streaming import gates, ingest


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def events(spark, *pairs):
    return spark.createDataFrame([(i, at(m)) for i, m in pairs], EVENTS)


def bucket_files(path):
    return {
        f"{folder}/{name}": (os.path.getmtime(f"{folder}/{name}"), os.path.getsize(f"{folder}/{name}"))
        for folder, _, names in os.walk(path)
        if "/_bucket=" in folder and "/_staged" not in folder
        for name in names
        if name.endswith(".parquet")
    }


# Bucketed merges ------------------------------------------------------------


def test_merge_reads_and_writes_only_touched_buckets(spark, folder):
    table = BucketedTable(spark, folder("t"), EVENTS, ["id"], buckets=64)
    everything = spark.range(2000).select("id", F.lit(at(1)).alias("event_ts"))
    first = table.merge(everything, newer_by="event_ts")
    assert (first["rows_inserted"], first["buckets_written"]) == (2000, 64)
    before = bucket_files(folder("t"))
    assert len(before) == 64

    done = table.merge(events(spark, (7, 5)), newer_by="event_ts")
    assert (done["buckets_read"], done["buckets_written"], done["rows_updated"]) == (1, 1, 1)
    after = bucket_files(folder("t"))
    assert sum(after.get(f) == v for f, v in before.items()) == 63 and len(after) == 64
    scan = table.read([table.read().select(table.bucket_of(events(spark, (7, 5)))).first()[0]])
    assert "PartitionFilters: [" in scan._jdf.queryExecution().executedPlan().toString()

    # A batch that is not newer writes nothing at all.
    for _ in range(2):
        again = table.merge(events(spark, (7, 5), (8, 1)), newer_by="event_ts")
        assert (again["buckets_written"], again["rows_merged"]) == (0, 0)
    assert bucket_files(folder("t")) == after and table.version() == 2
    assert {r["id"]: r["event_ts"] for r in table.read().collect()}[7] == at(5)


def test_null_keys_are_merged_once_however_often_they_come(spark, folder):
    table = BucketedTable(spark, folder("t"), EVENTS, ["id"], buckets=4)
    for _ in range(3):
        table.merge(events(spark, (None, 3), (1, 1)), newer_by="event_ts")
    assert rows(table.read()) == [(1, at(1)), (None, at(3))]
    raw = folder("raw")
    append(events(spark, (None, 9), (None, 4), (2, 2)), raw)
    for state in ("s1", "s2"):
        ingest.curate_merge(spark, raw, table, folder(state))
    assert rows(table.read()) == [(1, at(1)), (2, at(2)), (None, at(9))]


def test_two_writers_cannot_both_win(spark, folder):
    table = BucketedTable(spark, folder("t"), EVENTS, ["id"]).ensure()
    assert claim_file(spark, f"{folder('t')}/_claim", "other")
    with pytest.raises(TableClaimed):
        table.merge(events(spark, (1, 1)), owner="me")
    assert table.read().count() == 0
    # The run that died may go on, and it gives the table back.
    assert table.merge(events(spark, (1, 1)), owner="other")["rows_inserted"] == 1
    assert table.merge(events(spark, (2, 1)), owner="me")["rows_inserted"] == 1


def test_a_merge_that_died_halfway_is_finished_by_the_next(spark, folder, monkeypatch):
    table = BucketedTable(spark, folder("t"), EVENTS, ["id"], buckets=4)
    table.merge(events(spark, (1, 1), (2, 1), (3, 1)))
    real = buckets.BucketedTable._log

    def dies(self, changed, version):
        real(self, changed, version)
        raise RuntimeError("lost")

    monkeypatch.setattr(buckets.BucketedTable, "_log", dies)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(events(spark, (1, 7), (4, 7)), newer_by="event_ts")
    monkeypatch.setattr(buckets.BucketedTable, "_log", real)
    assert rows(table.read()) == [(1, at(1)), (2, at(1)), (3, at(1))]
    table.merge(events(spark, (2, 9)), newer_by="event_ts")
    assert rows(table.read()) == [(1, at(7)), (2, at(9)), (3, at(1)), (4, at(7))]
    assert table.version() == 3 and table.changes(1, 2).count() == 3


def test_deleting_a_whole_bucket(spark, folder):
    table = BucketedTable(spark, folder("t"), EVENTS, ["id"], buckets=4)
    table.merge(events(spark, (1, 1), (2, 1), (3, 1), (None, 1)))
    gone = events(spark, (1, 1), (2, 1), (3, 1), (None, 1), (9, 9)).withColumn("gone", F.lit(True))
    assert table.merge(gone, deleted="gone")["rows_deleted"] == 4
    assert table.read().count() == 0 and not bucket_files(folder("t"))


def test_snapshot_versions_are_never_shared(spark, folder, monkeypatch):
    table = SnapshotTable(spark, folder("t"), EVENTS).ensure()
    other = SnapshotTable(spark, folder("t"), EVENTS)
    versions, done = SnapshotTable.versions, []

    def meanwhile(self):
        """Another writer commits just after this one has looked."""
        found = versions(self)
        if self is table and not done:
            done.append(True)
            other.write(events(spark, (2, 2)))
        return found

    monkeypatch.setattr(SnapshotTable, "versions", meanwhile)
    with pytest.raises(ConcurrentWrite):
        table.write(events(spark, (1, 1)))
    monkeypatch.setattr(SnapshotTable, "versions", versions)
    assert rows(table.read()) == [(2, at(2))]


# Change streams -------------------------------------------------------------


def test_changes_are_delivered_once_even_after_a_crash(spark, folder):
    table = BucketedTable(spark, folder("t"), EVENTS, ["id"], buckets=4)
    stream, sink = ChangeStream(table, folder("s")), folder("sink")

    def keep(changes, number):
        append_batch(changes, sink, "w", number)

    def crash(changes, number):
        keep(changes, number)
        raise RuntimeError("before the commit")

    assert stream.pull(keep) == 0
    table.merge(events(spark, (1, 1), (2, 1), (None, 1)))
    assert stream.pull(keep) == 1
    table.merge(events(spark, (2, 5)), newer_by="event_ts")
    with pytest.raises(RuntimeError):
        stream.pull(crash)
    table.merge(events(spark, (1, 1)).withColumn("gone", F.lit(True)), deleted="gone")
    assert stream.position() == 1
    assert stream.pull(keep) == 2 and stream.pull(keep) == 3 and stream.pull(keep) == 3
    change = T.StructType([*EVENTS.fields, T.StructField("change_action", T.StringType()), T.StructField("is_update", T.BooleanType())])
    assert rows(batch_rows(spark, sink, change)) == sorted(
        [
            (1, at(1), "INSERT", False), (2, at(1), "INSERT", False), (None, at(1), "INSERT", False),
            (2, at(1), "DELETE", True), (2, at(5), "INSERT", True), (1, at(1), "DELETE", False),
        ],
        key=repr,
    )
    base = table.changes(0, 1).where("change_action = 'INSERT'").select("id", "event_ts")
    assert rows(apply_changes(base, table.changes(1, 3), ["id"])) == rows(table.read())


# One table of several writers -----------------------------------------------


def test_batch_and_stream_share_a_table(spark, folder):
    raw, table = folder("raw"), folder("curated")
    append(events(spark, (2, 2)), raw)
    counts = []
    append_batch(events(spark, (1, 1)), table, "backfill", 1)
    counts.append(batch_rows(spark, table, EVENTS).count())
    ingest.curate_append(spark, raw, table, folder("s"), writer="stream")
    counts.append(batch_rows(spark, table, EVENTS).count())
    append_batch(events(spark, (3, 3)), table, "backfill", 2)
    counts.append(batch_rows(spark, table, EVENTS).count())
    assert counts == [1, 2, 3]
    append_batch(events(spark, (3, 3)), table, "backfill", 2)
    ingest.curate_append(spark, raw, table, folder("other"), writer="stream")
    assert rows(batch_rows(spark, table, EVENTS)) == [(1, at(1)), (2, at(2)), (3, at(3))]
    assert curate_full_append(spark, raw, table, writer="full", run="day1") == "ok"
    assert curate_full_append(spark, raw, table, writer="full", run="day1") == "ok"
    assert batch_rows(spark, table, EVENTS).count() == 4


def test_a_folder_of_a_file_sink_refuses_batch_rows(spark, folder):
    append(events(spark, (1, 1)), folder("raw"))
    ingest.curate_append(spark, folder("raw"), folder("curated"), folder("s"))
    with pytest.raises(ValueError, match="file sink"):
        append(events(spark, (2, 2)), folder("curated"))


# Files of different layouts -------------------------------------------------

STAMP = "2024-01-01 00:05:00"


def put(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as file:
        file.write(body)


def test_detection_and_evolution_of_oddly_named_files(spark, folder):
    root = folder("in [1] x")
    put(root, "a b.csv", f"id;event_ts\n1;{STAMP}\n")
    put(root, "c+[2].csv", f"event_ts|id|Source|id2\n{STAMP}|2|web|x\n{STAMP}|2\n")
    put(root, "d%20.csv", f"id,event_ts\nx,{STAMP}\n\n3,\n")
    path = landing.literal_path(root)
    lines = landing.numbered(landing.text_lines(spark, path))
    landed = landing.typed_lines(lines, landing.file_layouts(lines, EVENTS), EVENTS, by_name=True).collect()
    found = {r[landing.LINE]: (r["id"], r["event_ts"], r[landing.EXTRA], r[landing.ERRORS]) for r in landed}
    assert found == {
        f"1;{STAMP}": (1, at(5), {}, []),
        f"{STAMP}|2|web|x": (2, at(5), {"source": "web", "id2": "x"}, []),
        f"{STAMP}|2": (2, at(5), None, ["field_count"]),
        f"x,{STAMP}": (None, at(5), {}, ["id"]),
        "3,": (3, None, {}, []),
    }
    assert {os.path.basename(r[landing.FILE]) for r in landed} == {"a b.csv", "c+[2].csv", "d%20.csv"}
    evolved = landing.read_csv_evolving(spark, path, EVENTS, delimiter="|")
    assert evolved.columns[:2] == ["id", "event_ts"] and {"id2", "source"} < set(evolved.columns)


def test_an_empty_folder_is_an_empty_table(spark, folder):
    os.makedirs(folder("in"))
    assert landing.read_csv_detected(spark, folder("in"), EVENTS).count() == 0
    assert landing.read_csv_evolving(spark, folder("in"), EVENTS).count() == 0


def test_stream_over_mixed_files(spark, folder):
    args = (folder("in"), folder("raw"), folder("bad"), folder("state"))
    put(folder("in"), "a.csv", f"id,event_ts\n1,{STAMP}\n")
    ingest.load_mixed(spark, *args)
    put(folder("in"), "b c.csv", f"Source;event_ts;id\nweb;{STAMP};2\nweb;{STAMP};zwei\n")
    put(folder("in"), "d.csv", "id\n3\n4,4\n")
    ingest.load_mixed(spark, *args, max_files=1)
    ingest.load_mixed(spark, *args)
    stored = T.StructType([*EVENTS.fields, T.StructField(landing.EXTRA, T.MapType(T.StringType(), T.StringType()))])
    assert sorted((r["id"], r["event_ts"], r[landing.EXTRA]) for r in batch_rows(spark, folder("raw"), stored).collect()) == [
        (1, at(5), {}), (2, at(5), {"source": "web"}), (3, None, {}),
    ]
    kept = T.StructType([T.StructField(landing.LINE, T.StringType()), T.StructField(landing.ERRORS, T.ArrayType(T.StringType()))])
    assert rows(batch_rows(spark, folder("bad"), kept)) == [("4,4", ["field_count"]), (f"web;{STAMP};zwei", ["id"])]
    put(folder("in"), "e[1].csv", "id\n5\n")
    with pytest.raises(Exception, match="glob characters"):
        ingest.load_mixed(spark, *args)


# Gates ----------------------------------------------------------------------


def test_deliveries_wait_until_they_are_complete(spark, folder):
    root, raw, bad = folder("in"), folder("raw"), folder("bad")
    manifest = spark.createDataFrame([("d 1", 2), ("d2", 2), ("d3", 1)], "delivery string, row_count long")
    assert sorted(r["delivery"] for r in gates.load_when_complete(spark, root, manifest, raw, bad).collect()) == ["d 1", "d2", "d3"]
    put(f"{root}/d 1", "a.csv", f"id,event_ts\n1,{STAMP}\n")
    put(f"{root}/d 1", "b.csv", f"id,event_ts\nx,{STAMP}\n")
    put(f"{root}/d2", "a.csv", f"id,event_ts\n3,{STAMP}\n")
    report = gates.load_when_complete(spark, root, manifest, raw, bad)
    assert rows(report) == [("d2", 2, 1), ("d3", 1, 0)]
    assert rows(batch_rows(spark, raw, EVENTS)) == [(1, at(5))]
    put(f"{root}/d2", "late.csv", f"id,event_ts\n4,{STAMP}\n")
    for _ in range(2):
        report = gates.load_when_complete(spark, root, manifest, raw, bad)
    assert rows(report) == [("d3", 1, 0)]
    assert rows(batch_rows(spark, raw, EVENTS)) == [(1, at(5)), (3, at(5)), (4, at(5))]
    kept = T.StructType([T.StructField(landing.LINE, T.StringType())])
    assert rows(batch_rows(spark, bad, kept)) == [(f"x,{STAMP}",)]


def test_lag_gate_tries_again_and_gives_up(spark, folder):
    raw, table, state = folder("raw"), folder("curated"), folder("s")
    append(events(spark, (1, 1)), raw)
    later = [events(spark, (2, 30))]

    def growing():
        if later:
            append(later.pop(), raw)
            return "2024-01-01 01:00:00"
        return newest_mark(spark, raw)

    report = gates.curate_until_fresh(spark, raw, table, state, "w", 60, newest_raw=growing)
    assert [r["lag_seconds"] for r in report] == [1800.0, 0.0]
    assert batch_rows(spark, table, EVENTS).count() == 2
    with pytest.raises(gates.LagError, match="behind after 2 tries"):
        gates.curate_until_fresh(spark, raw, table, state, "w", 60, tries=2, newest_raw=lambda: "2024-01-02 00:00:00")
    assert gates.curate_until_fresh(spark, folder("raw"), table, state, "w", 60)[0]["rows"] == 0


def test_freshness_comes_from_the_mark(spark, folder):
    raw = folder("raw")
    put(folder("in"), "a.csv", f"id,event_ts\n1,{STAMP}\n2,2024-01-01 00:09:00.5\nx,2025-01-01 00:00:00\n")
    ingest.load_landing(spark, folder("in"), raw, folder("s"))
    assert newest_mark(spark, raw) == "2024-01-01 00:09:00.5"
    row = gates.marked_freshness(spark, raw, at(10), 60).first()
    assert (row["newest_ts"], row["age_seconds"], row["is_stale"]) == (dt.datetime(2024, 1, 1, 0, 9, 0, 500000), 59, False)
    assert mark_newest(spark, raw, ["2023-01-01 00:00:00", None]) == "2024-01-01 00:09:00.5"
    assert gates.marked_freshness(spark, folder("none"), at(10), 60).first()["is_stale"]
    plan = gates.marked_freshness(spark, raw, at(10), 60)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


# Contracts ------------------------------------------------------------------


def test_texts_longer_than_their_column_are_refused(spark):
    good = (1, "s" * 64, 1, 1, 1.0, 1.0, "A", at(1))
    names = INVENTORY_REORDER_PLAN.names
    df = spark.createDataFrame([good, (2, "s" * 65, 1, 1, 1.0, 1.0, "AB", at(1)), (3, None, 1, 1, 1.0, 1.0, None, at(1))],
                               "product_id long, sku string, current_stock int, reorder_qty int, reorder_point double, safety_stock double, abc_class string, computed_at timestamp_ntz")
    found = {r["product_id"]: r["e"] for r in df.select("product_id", contract_errors(INVENTORY_REORDER_PLAN).alias("e")).collect()}
    assert found == {1: [], 2: ["length:sku", "length:abc_class"], 3: ["null:sku", "null:abc_class"]}
    assert required_not_null(df.where("product_id = 1"), INVENTORY_REORDER_PLAN).columns == names
    with pytest.raises(Exception, match="more than 64 characters in column sku"):
        required_not_null(df.where("product_id = 2"), INVENTORY_REORDER_PLAN).collect()
    assert CUSTOMER_LTV["ltv_tier"].metadata == {"max_length": 16}


def test_audit_report_scans_the_log_once(spark, folder, monkeypatch):
    from stockwell.plans import audit_report as plan

    put(folder("log"), "a.jsonl", '{"event_type":"event.received","payload":{}}\n\n  \n[1]\n{"event_type":\n{"event_type":"event.received","payload":{"event":{"platform":null}}}\n')
    scans = []
    real = plan.materialized

    def counted(df, name):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return real(df, name)

    monkeypatch.setattr(plan, "materialized", counted)
    report = plan.audit_report(spark, folder("log"))
    assert rows(report.platforms) == [("unknown", 1), (None, 1)]
    assert rows(report.stats) == [(2, 0, 0.0, 0.0)] and scans == [1]
    missing = plan.audit_report(spark, folder("none"))
    assert rows(missing.stats) == [(0, 0, 0.0, 0.0)] and rows(missing.platforms) == []
