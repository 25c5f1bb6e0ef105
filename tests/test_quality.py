import datetime as dt

from conftest import rows
from stockwell.operators import quality
from stockwell.schemas import EVENTS


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def events(spark, *pairs):
    return spark.createDataFrame([(i, at(m)) for i, m in pairs], EVENTS)


def test_safe_cast_names_failed_columns(spark):
    text = spark.createDataFrame([(1, "5", "1.5"), (2, "x", "y"), (3, None, "2")], "id int, a string, b string")
    types = {"a": "int", "b": "double"}
    assert rows(quality.safe_cast(text, types)) == [
        (1, 5, 1.5, []),
        (2, None, None, ["a", "b"]),
        (3, None, 2.0, []),
    ]
    good, bad = quality.split_cast(text, types)
    assert rows(good) == [(1, 5, 1.5), (3, None, 2.0)]
    assert rows(bad) == [(2, "x", "y", ["a", "b"])]


def test_canary_finds_missing_keys(spark):
    raw, curated = events(spark, (1, 1), (2, 2), (3, 3)), events(spark, (1, 1), (1, 1), (3, 3))
    assert rows(quality.missing_rows(raw, curated, ["id"])) == [(2, at(2))]
    assert tuple(quality.canary(raw, curated, ["id"]).first()) == (3, 3, 1)


def test_skipped_updates(spark):
    raw, curated = events(spark, (1, 1), (1, 5), (2, 2), (3, 3)), events(spark, (1, 1), (2, 2))
    assert rows(quality.skipped_updates(raw, curated)) == [(1, at(5), at(1)), (3, at(3), None)]


def test_lag_and_retry_gate(spark):
    raw = events(spark, (1, 1), (2, 2), (3, 30))
    row = quality.stream_lag(raw, events(spark, (1, 1), (2, 2)), 60).first()
    assert (row["lag_seconds"], row["backlog_rows"], row["needs_retry"]) == (28 * 60, 1, True)
    assert not quality.stream_lag(raw, raw, 60).first()["needs_retry"]
    nothing = raw.limit(0)
    assert quality.stream_lag(raw, nothing, 60).first()["needs_retry"]
    assert not quality.stream_lag(nothing, nothing, 60).first()["needs_retry"]


def test_completeness_reports_absent_and_short_files(spark):
    manifest = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3)], "file_name string, row_count long")
    delivered = spark.createDataFrame([("a",), ("a",), ("c",)], "file_name string")
    assert rows(quality.completeness(manifest, delivered)) == [("b", 1, 0), ("c", 3, 1)]
    assert rows(quality.completeness(manifest.select("file_name"), delivered)) == [("b", 0)]


def test_freshness(spark):
    fresh = quality.freshness(events(spark, (1, 1)), at(2), 60).first()
    assert (fresh["age_seconds"], fresh["is_stale"]) == (60, False)
    assert quality.freshness(events(spark, (1, 1)), at(3), 60).first()["is_stale"]
    assert quality.freshness(events(spark), at(3), 60).first()["is_stale"]


def test_arrived_null_keys_are_not_missing(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id long")
    assert quality.missing_rows(rows, rows, ["id"]).count() == 0
    assert tuple(quality.canary(rows, rows, ["id"]).first()) == (2, 2, 0)
