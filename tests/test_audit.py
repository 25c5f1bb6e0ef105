import datetime as dt
import json
import os

import pytest

from stockwell.operators.audit import audit_stats, platform_breakdown
from stockwell.operators.signals import normalize_signals
from stockwell.plans.audit_report import audit_report
from stockwell.schemas import SIGNALS
from stockwell.sources.audit_log import parse_audit_lines


def lines(spark, *values):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def received(platform=..., cid="a"):
    event = {} if platform is ... else {"platform": platform}
    return {"event_type": "event.received", "correlation_id": cid, "payload": {"event": event}}


def created(cid=...):
    row = {"event_type": "pr.created", "payload": {}}
    return row if cid is ... else {**row, "correlation_id": cid}


def classified(value):
    return {"event_type": "error.classified", "payload": {"confidence": value}}


def test_skips_blank_malformed_and_non_object_lines(spark):
    parsed = parse_audit_lines(lines(spark, "", "   ", "{broken", "[1, 2]", "7", " " + json.dumps(received("x")) + " "))
    assert [r["platform"] for r in parsed.collect()] == ["x"]


def test_kept_malformed_lines_count_nowhere(spark):
    text = lines(spark, "{broken", received("x"), "\t" + json.dumps(created("a")) + "\r")
    kept, skipped = parse_audit_lines(text, keep_malformed=True), parse_audit_lines(text)
    assert (kept.count(), skipped.count()) == (3, 2)
    assert audit_stats(kept).first() == audit_stats(skipped).first()
    assert platform_breakdown(kept).collect() == platform_breakdown(skipped).collect()


def test_absent_platform_is_unknown_and_null_is_its_own(spark):
    parsed = parse_audit_lines(
        lines(spark, received("x"), received("x"), received(), received(None), {"event_type": "event.received"})
    )
    got = {r["platform"]: r["incidents"] for r in platform_breakdown(parsed).collect()}
    assert got == {"x": 2, "unknown": 2, None: 1}


def test_rate_is_not_intersected_and_missing_id_counts_once(spark):
    parsed = parse_audit_lines(lines(spark, received("x"), created("q"), created("q"), created("r"), created(), created("")))
    row = audit_stats(parsed).first()
    assert (row["total_incidents"], row["incidents_with_pr"], row["success_rate"]) == (1, 3, 300.0)


def test_confidence_skips_what_is_no_number(spark):
    parsed = parse_audit_lines(
        lines(spark, classified(0.5), classified("0.25"), classified("high"), classified([1]), classified(None))
    )
    assert audit_stats(parsed).first()["avg_confidence"] == 0.375


def test_empty_log(spark):
    row = audit_stats(parse_audit_lines(lines(spark, ""))).first()
    assert (row["total_incidents"], row["success_rate"], row["avg_confidence"]) == (0, 0.0, 0.0)


def test_report_reads_files_and_accepts_a_missing_path(spark, folder):
    path = folder("audit")
    os.makedirs(path)
    with open(f"{path}/a.jsonl", "w") as out:
        out.write(json.dumps(received("x")) + "\n\n{bad\n" + json.dumps(created("a")) + "\n")
    report = audit_report(spark, path)
    assert report.stats.first()["success_rate"] == 100.0
    assert [tuple(r) for r in report.platforms.collect()] == [("x", 1)]
    assert audit_report(spark, folder("nowhere")).stats.first()["total_incidents"] == 0


def test_signals_fill_empty_defaults(spark):
    signals = spark.createDataFrame(
        [("j", "r", "sig", "text", None, ["a.py"], None), ("j2", "r2", "sig", "text", ["x"], None, {"k": "v"})], SIGNALS
    )
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    got = {r["job_id"]: r for r in normalize_signals(signals, "warehouse", moment).collect()}
    assert (got["j"]["artifacts"], got["j"]["code_paths"], got["j"]["config"]) == ([], ["a.py"], {})
    assert (got["j2"]["artifacts"], got["j2"]["code_paths"], got["j2"]["config"]) == (["x"], [], {"k": "v"})
    assert got["j"]["timestamp"] == "2024-01-02T03:04:05.000000+00:00"
    assert got["j"]["platform"] == "warehouse"


@pytest.mark.parametrize("value,expected", [(True, 1.0), (" 0.5 ", 0.5), (2, 2.0)])
def test_confidence_accepts_what_casts_to_a_number(spark, value, expected):
    parsed = parse_audit_lines(lines(spark, classified(value)))
    assert audit_stats(parsed).first()["avg_confidence"] == expected
