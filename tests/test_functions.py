import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stockwell import functions as S


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_month_gap_counts_month_starts(spark):
    pairs = [("2024-01-31", "2024-02-01", 1), ("2024-01-01", "2024-01-31", 0), ("2023-11-30", "2024-02-29", 3),
             ("2024-03-01", "2024-02-29", -1)]
    for start, end, expected in pairs:
        gap = S.month_gap(F.lit(start).cast("date"), F.lit(end).cast("date"))
        assert one(spark, gap)[0] == expected


def test_day_gap_counts_midnights(spark):
    start, end = F.lit("2024-01-01 23:59:00").cast("timestamp"), F.lit("2024-01-02 00:01:00").cast("timestamp")
    assert one(spark, S.day_gap(start, end))[0] == 1


def test_months_before_clips_to_month_end(spark):
    assert one(spark, S.months_before(dt.date(2024, 5, 31), 3))[0] == dt.date(2024, 2, 29)
    assert one(spark, S.months_before(dt.date(2023, 12, 31), 12))[0] == dt.date(2022, 12, 31)


def test_divide_policies(spark):
    ten, zero, none = F.lit(10), F.lit(0), F.lit(None).cast("int")
    assert one(spark, S.divide(ten, zero, "null"))[0] is None
    assert one(spark, S.divide(ten, zero, "fallback", fallback=F.lit(7)))[0] == 7.0
    assert one(spark, S.divide(none, zero, "error"))[0] is None
    assert one(spark, S.divide(ten, F.lit(4), "error"))[0] == 2.5
    with pytest.raises(Exception, match="division by zero: tenure"):
        one(spark, S.divide(ten, zero, "error", what="tenure"))
    with pytest.raises(ValueError):
        S.divide(ten, zero, "ignore")


def test_strict_extremes_keep_null(spark):
    none = F.lit(None).cast("double")
    assert one(spark, S.least_strict(F.lit(1.0), none))[0] is None
    assert one(spark, S.greatest_strict(F.lit(1.0), none))[0] is None
    assert one(spark, S.greatest_strict(F.lit(1.0), F.lit(2.0)))[0] == 2.0


@pytest.mark.parametrize(
    "score,tier", [(5000.0, "PLATINUM"), (4999.99, "GOLD"), (2000.0, "GOLD"), (500.0, "SILVER"), (499.0, "BRONZE"),
                   (-1.0, "BRONZE"), (None, "BRONZE")]
)
def test_ltv_tier_edges(spark, score, tier):
    assert one(spark, S.ltv_tier(F.lit(score).cast("double")))[0] == tier


@pytest.mark.parametrize("share,label", [(0.8, "A"), (0.8000001, "B"), (0.95, "B"), (0.96, "C"), (None, "C")])
def test_abc_class_edges(spark, share, label):
    assert one(spark, S.abc_class(F.lit(share).cast("double")))[0] == label


@pytest.mark.parametrize(
    "amount,tier", [(100.0, "low"), (100.01, "medium"), (1000.0, "medium"), (1000.01, "high"), (-5.0, "low"),
                    (None, None), (float("nan"), None)]
)
def test_revenue_tier_is_right_closed(spark, amount, tier):
    assert one(spark, S.revenue_tier(F.lit(amount).cast("double")))[0] == tier


def test_population_variance_is_exact(spark):
    values = [0.1] * 7
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.col("v").cast("decimal(18,2)").alias("v"))
    variance = df.agg(
        S.population_variance(F.count("v"), F.sum("v"), F.sum(F.col("v") * F.col("v")))
    ).first()[0]
    assert variance == 0.0


def test_population_variance_matches_definition(spark):
    values = [3, 5, 8, 13, 21]
    df = spark.createDataFrame([(v,) for v in values], "v int").select(F.col("v").cast("decimal(18,2)").alias("v"))
    variance = df.agg(
        S.population_variance(F.count("v"), F.sum("v"), F.sum(F.col("v") * F.col("v")))
    ).first()[0]
    mean = sum(values) / len(values)
    assert variance == pytest.approx(sum((v - mean) ** 2 for v in values) / len(values))


def test_retention_halves_in_half_life(spark):
    assert one(spark, S.retention(F.lit(180), math.log(2) / 180))[0] == pytest.approx(0.5)


def test_round_half_even_equals_python(spark):
    rng = random.Random(3)
    values = [2.675, 0.125, 0.375, -0.125, -2.675, 1.005, 166901.955, 110723.965, 0.0, 5e-324, 1e15, 4.5e15, 1e300,
              -1e18, 0.005, 0.015, 0.025]
    values += [rng.randint(-10**9, 10**9) / 1000 + 0.0005 for _ in range(3000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    values += [rng.randint(-10**8, 10**8) / 8 for _ in range(3000)]
    values += [round(rng.uniform(0, 1e5), 2) * (1 + n * 0.02) for n in range(1, 1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 3, 4):
        got = df.select("v", S.round_half_even(F.col("v"), digits).alias("r")).collect()
        assert [(r["v"], r["r"]) for r in got if r["r"] != round(r["v"], digits)] == []


def test_round_half_even_of_null_and_nan(spark):
    row = one(spark, S.round_half_even(F.lit(None).cast("double"), 2), S.round_half_even(F.lit(float("nan")), 2))
    assert row[0] is None and math.isnan(row[1])


def test_timestamps(spark):
    moment = dt.datetime(2024, 2, 3, 4, 5, 6, 7)
    row = one(spark, S.run_timestamp(moment), S.iso_timestamp(S.run_timestamp(moment)))
    assert row[0] == moment
    assert row[1] == "2024-02-03T04:05:06.000007+00:00"
