import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import queries
from conftest import rows
from stockwell.schemas import EVENTS, exact
from stockwell.sources import landing
from stockwell.streaming import ingest

T1, T2 = "2024-01-01 00:00:01", "2024-01-01 00:00:02.5"
D1, D2 = dt.datetime(2024, 1, 1, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 2, 500000)


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as out:
        out.write(text)


MIXED = f"id,event_ts\n1,{T1}\n2;{T2}\n3,{T1},extra\n4\nfive,{T1}\n6,yesterday\n7,{T2}\n8,\n"
BAD = {f"2;{T2}": ["field_count"], f"3,{T1},extra": ["field_count"], "4": ["field_count"], f"five,{T1}": ["id"],
       "6,yesterday": ["event_ts"]}


def test_csv_flags_every_kind_of_bad_row(spark, folder):
    put(folder("in"), "a.csv", MIXED)
    landed = landing.read_csv(spark, folder("in"), EVENTS)
    assert rows(landing.loadable(landed)) == [(1, D1), (7, D2), (8, None)]
    assert {r[landing.LINE]: r[landing.ERRORS] for r in landing.quarantined(landed).collect()} == BAD


def test_good_and_quarantined_are_all_rows_under_any_projection(spark, folder):
    put(folder("in"), "a.csv", MIXED)
    landed = landing.read_csv(spark, folder("in"), EVENTS)
    assert landing.loadable(landed).select("id").count() == 3
    assert landing.loadable(landed).count() + landing.quarantined(landed).count() == 8
    assert landing.quarantined(landed).select(F.size(landing.ERRORS)).count() == 5
    assert sorted(r[0] for r in landing.loadable(landed).select("id").collect()) == [1, 7, 8]


def test_quotes_are_ordinary_characters(spark, folder):
    put(folder("in"), "a.csv", f'id,event_ts\n"1",{T1}\n2,{T2}\n')
    landed = landing.read_csv(spark, folder("in"), EVENTS)
    assert rows(landing.loadable(landed)) == [(2, D2)]
    assert [r[landing.LINE] for r in landing.quarantined(landed).collect()] == [f'"1",{T1}']


def test_header_is_skipped_per_file(spark, folder):
    put(folder("in"), "a.csv", f"id,event_ts\n1,{T1}\n")
    put(folder("in"), "b.csv", f"id,event_ts\n2,{T2}\n")
    assert rows(landing.loadable(landing.read_csv(spark, folder("in"), EVENTS))) == [(1, D1), (2, D2)]


def test_json_rows(spark, folder):
    put(folder("in"), "a.json", f'{{"id": 1, "event_ts": "{T1}"}}\n\n{{"id": "x", "event_ts": "{T1}"}}\n{{"id": 3\n{{"id": 4}}\n')
    landed = landing.read_json(spark, folder("in"), EVENTS)
    assert rows(landing.loadable(landed)) == [(1, D1), (4, None)]
    bad = {r[landing.LINE]: r[landing.ERRORS] for r in landing.quarantined(landed).collect()}
    assert bad == {f'{{"id": "x", "event_ts": "{T1}"}}': ["id"], '{"id": 3': ["malformed"]}
    assert landing.loadable(landed).select("event_ts").count() == 2


def test_delimiters_are_detected_per_file(spark, folder):
    put(folder("in"), "a.csv", f"id,event_ts\n1,{T1}\n")
    put(folder("in"), "b.csv", f"id;event_ts\n2;{T2}\n3;{T2};x\n")
    put(folder("in"), "c.csv", f"id|event_ts\n4|{T2}\n")
    found = landing.detect_delimiters(spark, folder("in"), 2)
    assert {os.path.basename(r[landing.FILE]): r["delimiter"] for r in found.collect()} == {
        "a.csv": ",",
        "b.csv": ";",
        "c.csv": "|",
    }
    landed = landing.read_csv_detected(spark, folder("in"), EVENTS)
    assert rows(landing.loadable(landed)) == [(1, D1), (2, D2), (4, D2)]
    assert [r[landing.LINE] for r in landing.quarantined(landed).collect()] == [f"3;{T2};x"]


def test_new_missing_and_moved_columns(spark, folder):
    put(folder("in"), "a.csv", f"id,event_ts\n1,{T1}\n")
    put(folder("in"), "b.csv", f"event_ts,Source,id\n{T2},web,2\n")
    put(folder("in"), "c.csv", "id\n3\n")
    loaded = landing.loadable(landing.read_csv_evolving(spark, folder("in"), EVENTS))
    assert loaded.columns == ["id", "event_ts", "source"]
    assert rows(loaded) == [(1, D1, None), (2, D2, "web"), (3, None, None)]


@pytest.mark.parametrize("max_files", [None, 1])
def test_landing_stream_loads_each_file_once(spark, folder, max_files):
    args = (folder("in"), folder("raw"), folder("state"))
    put(folder("in"), "a.csv", MIXED)
    put(folder("in"), "b.csv", f"id,event_ts\n9,{T1}\n")
    ingest.load_landing(spark, *args, max_files=max_files)
    ingest.load_landing(spark, *args, max_files=max_files)
    assert [r[0] for r in rows(ingest.raw_rows(spark, folder("raw")))] == [1, 7, 8, 9]
    put(folder("in"), "c.csv", f"id,event_ts\n10,{T2}\nx,{T2}\n")
    ingest.load_landing(spark, *args, max_files=max_files)
    assert sorted(r["id"] for r in ingest.raw_rows(spark, folder("raw")).collect()) == [1, 7, 8, 9, 10]
    bad = {r[landing.LINE]: r[landing.ERRORS] for r in ingest.quarantine_rows(spark, folder("raw")).collect()}
    assert bad == {**BAD, f"x,{T2}": ["id"]}


def test_json_lines_with_other_fields_are_quarantined(spark, folder):
    good = f'{{"event_ts": "{T1}", "id": 1}}'
    unknown, twice = f'{{"id": 2, "event_ts": "{T1}", "x": 0}}', f'{{"id": 3, "id": 4, "event_ts": "{T1}"}}'
    lacking = '{"id": 5}'
    put(folder("in"), "a.json", "\n".join([good, unknown, twice, lacking]) + "\n")
    for missing, bad in (("null", {unknown, twice}), ("error", {unknown, twice, lacking})):
        landed = landing.read_json(spark, folder("in"), EVENTS, missing=missing)
        found = {r[landing.LINE]: r[landing.ERRORS] for r in landing.quarantined(landed).collect()}
        assert found == {line: ["field_count"] for line in bad}
    ingest.load_landing(spark, folder("in"), folder("raw"), folder("c"), file_format="json")
    assert rows(ingest.raw_rows(spark, folder("raw"))) == [(1, D1)]
    assert ingest.quarantine_rows(spark, folder("raw")).count() == 3


def test_measures_that_do_not_fit_fail_the_job(spark):
    def read(value, kind):
        df = spark.createDataFrame([(value,)], f"x {kind}")
        return df.select(exact(df, "x", 2).alias("x")).first().x

    assert [read(v, k) for v, k in ((0.1, "double"), (0.1, "float"), (7, "long"), ("1.5", "string"), (None, "double"))] == [
        Decimal("0.10"), Decimal("0.10"), Decimal("7.00"), Decimal("1.50"), None,
    ]
    for value in (0.004, 1e17, float("nan")):
        with pytest.raises(Exception, match="does not fit"):
            read(value, "double")


def test_refused_customers_are_rows_of_the_upserts(spark, monkeypatch):
    names = "customer_id long, ltv_score double, ltv_tier string, predicted_revenue_12m double, churn_risk_score double"
    scored = spark.createDataFrame([(1, 5.0, "LOW", 1.0, 0.1), (2, None, None, None, None)], names)
    monkeypatch.setattr(queries, "_scored", lambda *_: scored)
    monkeypatch.setattr(queries, "_previous_orders", lambda *_: None)
    for query in (queries.upsert_ltv, queries.upsert_ltv_unconditional):
        assert {r.customer_id: r.action == "refused" for r in query(spark, "").collect()} == {1: False, 2: True}
