import datetime as dt
import math
from decimal import Decimal

import pytest

from stockwell.operators.customers import by_revenue, customer_order_stats, order_revenue, recency_features
from stockwell.operators.ltv import score_runner, score_sql
from stockwell.plans.customer_ltv import scored_customers
from stockwell.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS

REF = dt.date(2024, 6, 15)
NOW = dt.datetime(2024, 6, 15)


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def sources(spark):
    people = [(i, f"n{i}", "x", f"{i}@example.com", NOW) for i in (1, 2, 3, 4, 5)]
    orders = [
        # customer 1: two completed orders, one open
        (10, 1, day("2024-01-10"), NOW, "completed"),
        (11, 1, day("2024-06-01"), NOW, "completed"),
        (12, 1, day("2024-06-02"), NOW, "open"),
        # customer 2: only an open order; customer 3: none
        (20, 2, day("2024-05-01"), NOW, "open"),
        # customer 4: completed order without items
        (40, 4, day("2024-02-01"), NOW, "completed"),
        # customer 5: first order in the reference month
        (50, 5, day("2024-06-03"), NOW, "completed"),
    ]
    items = [
        (10, 100, Decimal(1), Decimal("30.00"), NOW),
        (10, 101, Decimal(2), Decimal("50.00"), NOW),
        (11, 100, Decimal(1), Decimal("20.00"), NOW),
        (12, 100, Decimal(9), Decimal("999.00"), NOW),
        (50, 100, Decimal(1), Decimal("70.00"), NOW),
    ]
    return (
        spark.createDataFrame(people, CUSTOMERS),
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(items, ORDER_ITEMS),
    )


def by_id(df):
    return {r["customer_id"]: r for r in df.collect()}


def test_sql_stats(sources):
    got = by_id(customer_order_stats(*sources, REF, "sql"))
    first = got[1]
    assert (first["order_count"], first["total_revenue"], first["avg_order_value"]) == (2, 100, 50.0)
    assert (first["total_units"], first["revenue_last_12m"], first["orders_last_3m"]) == (4, 100, 1)
    assert (first["first_order_date"], first["last_order_date"]) == (day("2024-01-10"), day("2024-06-01"))
    assert (got[3]["order_count"], got[3]["total_revenue"], got[3]["revenue_last_12m"]) == (0, None, 0)
    assert (got[4]["order_count"], got[4]["total_revenue"], got[4]["revenue_last_12m"]) == (1, None, None)


def test_runner_stats_average_lines_and_default_to_zero(sources):
    got = by_id(customer_order_stats(*sources, REF, "runner"))
    assert got[1]["avg_order_value"] == pytest.approx(100 / 3)
    assert (got[2]["order_count"], got[2]["total_revenue"], got[2]["avg_order_value"]) == (0, 0, 0.0)
    assert got[4]["total_revenue"] == 0


def test_repeated_order_rows_count_once(spark, sources):
    people, orders, items = sources
    twice = orders.unionByName(orders.filter("order_id = 11"))
    got = by_id(customer_order_stats(people, twice, items, REF, "sql"))
    assert got[1]["order_count"] == 2
    assert got[1]["total_revenue"] == 120  # the join repeats the order's lines


def test_order_revenue_one_row_per_order(sources):
    got = {r["order_id"]: (r["order_revenue"], r["order_units"]) for r in order_revenue(sources[2]).collect()}
    assert got[10] == (80, 3)


def test_recency_drops_zero_order_customers(sources):
    got = by_id(recency_features(customer_order_stats(*sources, REF, "sql"), REF))
    assert set(got) == {1, 4, 5}
    assert (got[1]["days_since_last_order"], got[1]["tenure_months"]) == (14, 5)
    assert got[1]["avg_days_between_orders"] == 143.0
    assert got[4]["avg_days_between_orders"] is None


def test_sql_score(sources):
    got = by_id(scored_customers(*sources, REF, "sql", on_zero="null"))
    kept = math.exp(-0.003851 * 14)
    forecast = 100 / 5 * 12 * kept
    assert got[1]["predicted_revenue_12m"] == pytest.approx(forecast)
    assert got[1]["ltv_score"] == pytest.approx(forecast * (0.7 + 0.3 * 0.1))
    assert got[1]["churn_risk_score"] == pytest.approx(1 - kept)
    assert (got[4]["ltv_score"], got[4]["ltv_tier"]) == (None, "BRONZE")


def test_tenure_zero_policies(sources):
    with pytest.raises(Exception, match="division by zero: tenure_months"):
        scored_customers(*sources, REF, "sql", on_zero="error").collect()
    assert by_id(scored_customers(*sources, REF, "sql", on_zero="null"))[5]["ltv_score"] is None
    assert by_id(scored_customers(*sources, REF, "sql", on_zero="fallback"))[5]["avg_monthly_revenue"] == 70.0


def test_runner_score(sources):
    stats = customer_order_stats(*sources, REF, "runner")
    got = by_id(score_runner(stats, REF, on_zero="null"))
    kept = math.exp(-14 * math.log(2) / 180)
    forecast = round(100 / 5 * 12 * kept, 2)
    assert got[1]["predicted_revenue_12m"] == forecast
    assert got[1]["ltv_score"] == round(forecast * 1.04, 2)
    assert got[1]["churn_risk_score"] == round(1 - kept, 4)
    idle = got[3]
    assert (idle["ltv_score"], idle["ltv_tier"], idle["predicted_revenue_12m"], idle["churn_risk_score"]) == (
        0.0,
        "BRONZE",
        0.0,
        1.0,
    )


def test_runner_raises_on_tenure_zero(sources):
    stats = customer_order_stats(*sources, REF, "runner")
    with pytest.raises(Exception, match="division by zero: tenure_months"):
        score_runner(stats, REF).collect()


def test_backtest_keeps_later_orders_unless_as_of(sources):
    back = day("2024-03-01")
    plain = by_id(customer_order_stats(*sources, back, "sql"))
    bounded = by_id(customer_order_stats(*sources, back, "sql", as_of=True))
    assert (plain[1]["order_count"], bounded[1]["order_count"]) == (2, 1)
    scored = by_id(score_sql(recency_features(customer_order_stats(*sources, back, "sql"), back), "null"))
    assert scored[1]["churn_risk_score"] < 0


def test_frequency_score_is_capped(spark):
    features = spark.createDataFrame(
        [(1, 12, Decimal("1200.00"), 25, 10, 0)],
        "customer_id long, tenure_months int, total_revenue decimal(18,2), orders_last_3m long, order_count long,"
        " days_since_last_order int",
    )
    row = score_sql(features).first()
    assert (row["frequency_score"], row["ltv_score"]) == (1.0, 1200.0)


def test_by_revenue_puts_unknown_first(sources):
    got = [r["total_revenue"] for r in by_revenue(customer_order_stats(*sources, REF, "sql")).collect()]
    known = [v for v in got if v is not None]
    assert got[: len(got) - len(known)] == [None] * 3 and known == sorted(known, reverse=True)
