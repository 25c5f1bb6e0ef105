import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stockwell.plans.event_curation import curate_changes, curate_full_append, guarded_curate_append
from stockwell.schemas import EVENTS
from stockwell.sinks.snapshot import SnapshotTable
from stockwell.sinks.writers import append
from stockwell.sources.changes import apply_changes, table_changes
from stockwell.streaming import ingest


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def events(spark, *pairs):
    return spark.createDataFrame([(i, at(m)) for i, m in pairs], EVENTS)


def test_append_takes_each_row_once_across_runs(spark, folder):
    raw, curated, state = folder("raw"), folder("curated"), folder("state")
    append(events(spark, (1, 1), (2, 2)), raw)
    ingest.curate_append(spark, raw, curated, state)
    append(events(spark, (3, 3)), raw)
    ingest.curate_append(spark, raw, curated, state)
    ingest.curate_append(spark, raw, curated, state)
    assert rows(spark.read.parquet(curated)) == [(1, at(1)), (2, at(2)), (3, at(3))]


@pytest.mark.parametrize("max_files", [None, 1])
def test_merge_keeps_the_newest_row_however_files_are_batched(spark, folder, max_files):
    raw, state = folder("raw"), folder("state")
    target = SnapshotTable(spark, folder("curated"), EVENTS).ensure()
    for part in ([(1, 5), (2, 1)], [(1, 3), (2, 9)], [(3, 1), (1, 4), (3, 2)]):
        append(events(spark, *part).coalesce(1), raw)
    ingest.curate_merge(spark, raw, target, state, max_files)
    expected = [(1, at(5)), (2, at(9)), (3, at(2))]
    assert rows(target.read()) == expected
    ingest.curate_merge(spark, raw, target, state, max_files)
    assert rows(target.read()) == expected


def test_replay_after_a_lost_checkpoint_changes_nothing(spark, folder):
    raw = folder("raw")
    target = SnapshotTable(spark, folder("curated"), EVENTS, keep=2).ensure()
    for minute in (1, 2, 3):
        append(events(spark, (1, minute), (minute, 9)).coalesce(1), raw)
        ingest.curate_merge(spark, raw, target, folder("state"))
    done = rows(target.read())
    append(events(spark, (7, 7)), raw)
    ingest.curate_merge(spark, raw, target, folder("other-state"))
    assert rows(target.read()) == sorted([*done, (7, at(7))], key=repr)
    assert len(target.versions()) == 2


def test_full_append_repeats_all_rows(spark, folder):
    raw, curated = folder("raw"), folder("curated")
    append(events(spark, (1, 1)).withColumn("extra", F.lit("x")), raw)
    assert curate_full_append(spark, raw, curated) == "ok"
    assert curate_full_append(spark, raw, curated) == "ok"
    assert rows(spark.read.parquet(curated)) == [(1, at(1)), (1, at(1))]


def test_change_feed_images_and_their_unfiltered_append(spark, folder):
    before = events(spark, (1, 1), (2, 2), (3, 3))
    after = events(spark, (1, 1), (2, 9), (4, 4))
    changes = table_changes(before, after, ["id"])
    assert rows(changes) == [
        (2, at(2), "DELETE", True),
        (2, at(9), "INSERT", True),
        (3, at(3), "DELETE", False),
        (4, at(4), "INSERT", False),
    ]
    curate_changes(changes, folder("curated"))
    assert spark.read.parquet(folder("curated")).count() == 4
    assert rows(apply_changes(before, changes, ["id"])) == rows(after)


def test_guard_skips_a_stale_stream(spark, folder):
    raw, curated, state = folder("raw"), folder("curated"), folder("state")
    append(events(spark, (1, 1)), raw)
    assert not guarded_curate_append(spark, raw, curated, state, at(30), max_age_seconds=60)
    assert guarded_curate_append(spark, raw, curated, state, at(2), max_age_seconds=60)
    assert rows(spark.read.parquet(curated)) == [(1, at(1))]


def test_old_files_and_quarantine(spark, folder):
    """A file much older than the newest one is loaded; quarantined rows stay out of CURATED."""
    landing, raw = folder("landing"), folder("raw")
    os.makedirs(landing)

    def deliver(name, body, age_days=0):
        path = f"{landing}/{name}"
        with open(path, "w") as file:
            file.write("id,event_ts\n" + body)
        then = time.time() - age_days * 86_400
        os.utime(path, (then, then))

    deliver("a.csv", "1,2001-01-01 00:00:00\n")
    ingest.load_landing(spark, landing, raw, folder("c"))
    deliver("b.csv", "2,2001-01-02 00:00:00\nx,2001-01-03 00:00:00\n", age_days=90)
    deliver("c.csv", "3,2001-01-04 00:00:00\n")
    ingest.load_landing(spark, landing, raw, folder("c"))
    assert sorted(r["id"] for r in ingest.raw_rows(spark, raw).collect()) == [1, 2, 3]
    curate_full_append(spark, raw, folder("curated"))
    assert sorted(r["id"] for r in spark.read.parquet(folder("curated")).collect()) == [1, 2, 3]
