import datetime as dt

import pytest

from stockwell.operators.sales import clean_orders, tier_orders, validation_counts
from stockwell.plans.daily_sales import daily_sales_job

DAY = dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def staging(spark):
    return spark.createDataFrame(
        [
            (1, 1, DAY, 100.0, "web"),
            (2, 1, DAY, 1000.0, "web"),
            (3, 1, DAY, 1000.5, None),
            (4, None, DAY, 5.0, "web"),
            (5, 1, None, 5.0, "web"),
            (6, 1, DAY, float("nan"), "web"),
        ],
        "order_id long, customer_id long, order_date date, total_amount double, channel string",
    )


def test_rows_without_required_values_are_dropped(staging):
    kept = clean_orders(staging)
    assert sorted(r["order_id"] for r in kept.collect()) == [1, 2, 3]
    assert tuple(validation_counts(staging).first()) == (6, 3, 3)


def test_missing_column_is_an_error(staging):
    with pytest.raises(ValueError, match="total_amount"):
        clean_orders(staging.drop("total_amount"))


def test_upper_case_names(staging):
    upper = staging.toDF(*[c.upper() for c in staging.columns])
    assert clean_orders(upper).count() == 3
    with pytest.raises(ValueError, match="order_id"):
        clean_orders(upper, normalize_first=False)


def test_tiers_and_stamp(staging):
    got = {r["order_id"]: r for r in tier_orders(clean_orders(staging), DAY).collect()}
    assert {i: r["revenue_tier"] for i, r in got.items()} == {1: "low", 2: "medium", 3: "high"}
    assert got[3]["channel"] is None
    assert (got[1]["pipeline_run_date"], got[1]["pipeline_version"]) == (DAY, "1.4.2")


def test_job_appends_and_counts(spark, staging, folder):
    fact = folder("fact")
    expected = {"rows_extracted": 6, "rows_kept": 3, "rows_loaded": 3, "rows_dropped": 3}
    assert daily_sales_job(staging, fact, DAY) == expected
    assert daily_sales_job(staging, fact, DAY) == expected
    assert spark.read.parquet(fact).count() == 6
