import pytest

from conftest import rows
from stockwell.operators.upsert import upsert, upsert_counts

SCHEMA = "k long, a double, b string, ts long"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(1, 1.0, "x", 0), (2, 2.0, "x", 0), (3, None, "x", 0), (4, 4.0, "x", 0)], SCHEMA
    )


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(1, 1.0, "x", 9), (2, 2.5, "x", 9), (3, 3.0, "x", 9), (5, 5.0, "y", 9)], SCHEMA)


def test_conditional_upsert_keeps_unchanged_rows_and_null_compares(target, source):
    merged = upsert(target, source, ["k"], compare=["a", "b"])
    assert rows(merged) == [
        (1, 1.0, "x", 0, "kept"),
        (2, 2.5, "x", 9, "updated"),
        (3, None, "x", 0, "kept"),
        (4, 4.0, "x", 0, "kept"),
        (5, 5.0, "y", 9, "inserted"),
    ]
    assert tuple(upsert_counts(merged).first()) == (1, 1, 2)


def test_null_safe_compare_sees_null(target, source):
    merged = upsert(target, source, ["k"], compare=["a"], null_safe=True)
    assert (3, 3.0, "x", 9, "updated") in rows(merged)


def test_unconditional_upsert_rewrites_every_match(target, source):
    merged = upsert(target, source, ["k"])
    assert [r[-1] for r in rows(merged)] == ["updated", "updated", "updated", "kept", "inserted"]
    assert tuple(upsert_counts(merged).first()) == (1, 3, 4)


def test_update_list_limits_rewritten_columns(target, source):
    merged = upsert(target, source, ["k"], update=["a"])
    got = rows(merged)
    assert got[1] == (2, 2.5, "x", 0, "updated")
    assert got[4] == (5, 5.0, "y", 9, "inserted")


def test_empty_source_changes_nothing(spark, target):
    merged = upsert(target, spark.createDataFrame([], SCHEMA), ["k"])
    assert rows(merged.drop("_action")) == rows(target)
    assert tuple(upsert_counts(merged).first()) == (0, 0, 0)


def test_second_run_updates_nothing(target, source):
    once = upsert(target, source, ["k"], compare=["a", "b"], null_safe=True).drop("_action")
    again = upsert(once, source, ["k"], compare=["a", "b"], null_safe=True)
    assert tuple(upsert_counts(again).first()) == (0, 0, 0)


def test_cast_before_compare_ignores_rounding_on_write(spark):
    stored = spark.createDataFrame([(1, "2.35")], "k long, s string").selectExpr("k", "cast(s as decimal(18,2)) as v")
    fresh = spark.createDataFrame([(1, 2.3456)], "k long, v double")
    faithful = upsert(stored, fresh, ["k"], compare=["v"])
    rounded = upsert(stored, fresh, ["k"], compare=["v"], cast_before_compare=True)
    assert [r["_action"] for r in faithful.collect()] == ["updated"]
    assert [r["_action"] for r in rounded.collect()] == ["kept"]


def test_newer_by_never_goes_back(spark, target):
    late = spark.createDataFrame([(1, 8.0, "z", -5), (2, 8.0, "z", 5)], SCHEMA)
    got = rows(upsert(target, late, ["k"], newer_by="ts"))
    assert got[0] == (1, 1.0, "x", 0, "kept")
    assert got[1] == (2, 8.0, "z", 5, "updated")


def test_key_types_are_taken_from_the_target(spark, target):
    text_keys = spark.createDataFrame([("1", 7.0, "t", 9)], "k string, a double, b string, ts long")
    assert (1, 7.0, "t", 9, "updated") in rows(upsert(target, text_keys, ["k"]))


def test_duplicate_source_rows(spark, target):
    twice = spark.createDataFrame([(1, 7.0, "t", 9), (1, 8.0, "t", 9)], SCHEMA)
    with pytest.raises(Exception, match="several source rows match one target row"):
        upsert(target, twice, ["k"], reject_duplicates=True).collect()
    new_twice = spark.createDataFrame([(9, 7.0, "t", 9), (9, 8.0, "t", 9)], SCHEMA)
    merged = upsert(target, new_twice, ["k"], reject_duplicates=True)
    assert tuple(upsert_counts(merged).first()) == (2, 0, 2)


def test_duplicate_check_adds_no_exchange(spark, target, source):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            upsert(target, source, ["k"], reject_duplicates=check)._jdf.queryExecution().executedPlan().toString()
            for check in (False, True)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange hashpartitioning") == plans[1].count("Exchange hashpartitioning") == 2
