import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockwell.operators.ltv import ltv_ranks
from stockwell.operators.ranking import abc_classify, cumulative_share, ordered

pytestmark = pytest.mark.usefixtures("many_slices")


def table(spark, values, kind="decimal(18,2)"):
    df = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(values)], "id long, t string")
    return df.select("id", F.col("t").cast(kind).alias("v")).repartition(4)


def naive(df, descending):
    order = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
    by_value, by_row = Window.orderBy(order), Window.orderBy(order, "id")
    frame = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        "id",
        F.row_number().over(by_row).cast("long"),
        F.percent_rank().over(by_value),
        F.coalesce(F.sum("v").over(frame), F.lit(0)).cast("decimal(38,2)"),
    )


def shapes():
    rng = random.Random(7)
    yield "distinct", [rng.randint(0, 10**6) for _ in range(400)]
    yield "a third tied", [50 if rng.random() < 0.4 else rng.randint(0, 100) for _ in range(400)]
    yield "all tied", [5] * 300
    yield "many nulls", [None if rng.random() < 0.4 else rng.randint(0, 9) for _ in range(300)]
    yield "all null", [None] * 50
    yield "one row", [3]
    yield "two ties", [3, 3]
    yield "negative", [rng.randint(-50, 50) for _ in range(200)]
    yield "empty", []


@pytest.mark.parametrize("name,values", list(shapes()), ids=[n for n, _ in shapes()])
@pytest.mark.parametrize("descending", [False, True])
def test_equals_single_task_windows(spark, name, values, descending):
    df = table(spark, values)
    mine = ordered(
        df,
        "v",
        F.col("id"),
        descending=descending,
        row_number="rn",
        percent_rank="pr",
        running_total="total",
        reverse_row_number="back",
    )
    got = sorted((r["id"], r["rn"], r["pr"], r["total"]) for r in mine.collect())
    assert got == sorted(tuple(r) for r in naive(df, descending).collect())
    assert all(r["back"] == len(values) + 1 - r["rn"] for r in mine.collect())


def test_hot_value_is_spread_over_slices(spark):
    df = table(spark, [5] * 4000)
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    sizes = [r["n"] for r in df.repartitionByRange(*order).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1500


def test_nan_ties(spark):
    df = table(spark, [float("nan")] * 40 + [1.0] * 40, "double")
    mine = ordered(df, "v", F.col("id"), percent_rank="pr")
    values = {r["pr"] for r in mine.collect()}
    assert values == {0.0, 40 / 79}


def test_no_single_partition_window(spark):
    plan = cumulative_share(table(spark, range(50)), "v", "id")._jdf.queryExecution().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_ltv_ranks_order_and_ties(spark):
    scored = spark.createDataFrame(
        [(1, 10.0, Decimal(5)), (2, 10.0, Decimal(1)), (3, None, None), (4, 99.0, Decimal(9))],
        "customer_id long, ltv_score double, total_revenue decimal(18,2)",
    )
    got = {r["customer_id"]: r for r in ltv_ranks(scored).collect()}
    assert [got[i]["ltv_global_rank"] for i in (3, 4, 1, 2)] == [1, 2, 3, 4]
    assert [got[i]["ltv_pct_rank"] for i in (1, 2, 4, 3)] == [0.0, 0.0, 2 / 3, 1.0]
    assert [got[i]["revenue_pct_rank"] for i in (2, 1, 4, 3)] == [0.0, 1 / 3, 2 / 3, 1.0]


def test_abc_edge_at_exactly_eighty_percent(spark):
    df = table(spark, [80, 15, 5])
    got = {r["id"]: r["abc_class"] for r in abc_classify(df, "v", "id").collect()}
    assert got == {0: "A", 1: "B", 2: "C"}


def test_abc_single_dominant_product_is_lowest(spark):
    df = table(spark, [9900, 50, 50])
    got = {r["id"]: r["abc_class"] for r in abc_classify(df, "v", "id").collect()}
    assert got == {0: "C", 1: "C", 2: "C"}


def test_abc_without_revenue(spark):
    got = abc_classify(table(spark, [0, 0]), "v", "id").collect()
    assert {r["abc_class"] for r in got} == {"C"}
    assert {r["cumulative_revenue_pct"] for r in got} == {None}


def test_shares_never_fall(spark):
    rng = random.Random(1)
    df = table(spark, [rng.randint(0, 1000) for _ in range(300)])
    got = sorted(cumulative_share(df, "v", "id").collect(), key=lambda r: (-r["v"], r["id"]))
    shares = [r["cumulative_revenue_pct"] for r in got]
    assert shares == sorted(shares) and shares[-1] == 1.0


def test_doubles_are_summed_exactly_or_refused(spark):
    df = table(spark, [6e-5, 5e-5, 3e-5], "double")
    got = {r["id"]: r for r in ordered(df, "v", "id", descending=True, running_share="share", scale=5).collect()}
    assert [got[i]["share"] for i in range(3)] == pytest.approx([6 / 14, 11 / 14, 1.0])
    with pytest.raises(Exception, match="does not fit"):
        cumulative_share(df, "v", "id").collect()
    halves = table(spark, [0.5, 0.25, 0.25], "double")
    assert sorted(r["abc_class"] for r in abc_classify(halves, "v", "id").collect()) == ["A", "A", "C"]


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]


def test_only_narrow_rows_are_sorted_and_one_file_serves_both_ranks(spark, monkeypatch):
    from stockwell.operators import ranking

    stored, real, by_slice = [], ranking.materialized, ranking.colocated

    def recorded(df, name):
        stored.append((name, df.columns, exchanges(df)))
        return real(df, name)

    def recorded_slices(df, path, key, buckets):
        stored.append(("slices", df.columns, exchanges(df)))
        return by_slice(df, path, key, buckets)

    monkeypatch.setattr(ranking, "materialized", recorded)
    monkeypatch.setattr(ranking, "colocated", recorded_slices)
    scored = table(spark, range(40)).select(
        F.col("id").alias("customer_id"), F.col("v").cast("double").alias("ltv_score"), F.col("v").alias("total_revenue"),
        *[F.lit("wide").alias(f"wide{i}") for i in range(10)],
    )
    result = ltv_ranks(scored)
    assert result.count() == 40 and set(scored.columns) < set(result.columns)
    assert [name for name, *_ in stored] == ["ordered", "slices", "slices"]
    for name, columns, found in stored[1:]:
        assert "wide0" not in columns and len(found) == 1 and "rangepartitioning" in found[0]


def test_one_exchange_for_each_order(spark):
    """After the range exchange of the stored slices nothing moves by slice or value, only joins by row number do."""
    df = ordered(table(spark, range(50)), "v", "id", percent_rank="pr", running_total="total", running_share="share")
    found = [x for x in exchanges(df) if "BroadcastExchange" not in x]
    assert all("hashpartitioning(_row" in x for x in found)
    assert "Bucketed: true" in df._jdf.queryExecution().executedPlan().toString()


def test_position_needs_no_window(spark):
    df = ordered(table(spark, range(50)), "v", "id", row_number="rn", reverse_row_number="back")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan
    assert sorted(r["rn"] for r in df.collect()) == list(range(1, 51))
