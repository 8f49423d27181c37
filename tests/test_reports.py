from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import CUSTOMERS, LINES, ORDERS, given, operators, plan, values

from tidemart.functions import money_text, round_to, threshold_status
from tidemart.functions.status import (
    FAILED_RUNS_STEPS,
    PENDING_FILES_STEPS,
    SNAPSHOT_AGE_STEPS,
    SUCCESS_RATE_STEPS,
)
from tidemart.operators import reports
from tidemart.operators.joins import join_inner_customer
from tidemart.operators.marts import order_revenue
from tidemart.plans.models import build_models


@pytest.fixture(scope="module")
def hot(spark):
    """One customer holds a third of the orders; one order has no customer."""
    orders = [
        {"order_id": i, "customer_id": 1 if i % 3 == 0 else i % 50, "order_amount": i / 4,
         "order_date": dt.date(2024, 1, 1) + dt.timedelta(days=i % 90), "order_status": "O"}
        for i in range(3000)
    ] + [
        {"order_id": 9000, "customer_id": 777, "order_amount": 1.0,
         "order_date": dt.date(2030, 1, 1)},
        {"order_id": 9001, "customer_id": None, "order_amount": 1.0,
         "order_date": dt.date(2030, 1, 1)},
    ]
    lines = [
        {"order_id": i % 2500, "quantity": 1.0 + i % 5, "net_price": i / 8,
         "gross_price": i / 4, "return_flag": "RAN"[i % 3]}
        for i in range(8000)
    ]
    customers = [
        {"customer_id": i, "customer_name": f"c{i}", "market_segment": "AB"[i % 2]}
        for i in range(50)
    ]
    return (given(spark, ORDERS, *orders), given(spark, LINES, *lines),
            given(spark, CUSTOMERS, *customers))


def test_recent_orders_do_not_need_the_mart(hot):
    orders, lines, customers = hot
    want = reports.recent_orders(order_revenue(orders, lines), customers, 15)
    got = reports.recent_orders_live(orders, lines, customers, 15)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert got.where("order_id >= 9000").count() == 0


def test_recent_orders_read_each_table_once(spark, sf):
    models = build_models(spark, sf)
    got = reports.recent_orders_live(models["stg_orders"], models["stg_lineitem"], models["stg_customers"])
    # The orders and customers have been read; the lines are read by key.
    assert operators(got, "FileScan") == 1
    assert "PushedFilters: [In(l_orderkey, [" in plan(got)


def test_recent_orders_of_more_than_all_rows(hot):
    orders, lines, customers = hot
    n = 20_000
    assert reports.recent_orders_live(orders, lines, customers, n).count() == 3000


def test_segments_equal_the_plain_aggregation(hot):
    orders, lines, customers = hot
    mart = order_revenue(orders, lines)
    plain = (
        join_inner_customer(mart, customers).groupBy("market_segment")
        .agg(F.count(F.lit(1)).alias("total_orders"),
             money_text(F.sum("net_revenue")).alias("net_revenue"),
             money_text(F.avg("net_revenue")).alias("avg_order_revenue"),
             round_to(F.avg("return_rate_pct"), 2).alias("avg_return_rate_pct"))
    )
    assert values(reports.revenue_by_segment(mart, customers)) == values(plain)


def test_segment_join_moves_one_row_per_customer(hot):
    orders, lines, customers = hot
    report = reports.revenue_by_segment(order_revenue(orders, lines), customers)
    text = plan(report)
    assert text.index("Join [customer_id") < text.index("HashAggregate(keys=[customer_id")


def test_a_hot_customer_is_split_by_adaptive_execution(spark, hot):
    orders, _, customers = hot
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = join_inner_customer(orders.repartition(8), customers)
        assert len(joined.collect()) == 3000
        assert "skew=true" in plan(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_order_frequency_counts_no_orders_in_the_last_bucket(spark):
    mart = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4)], "total_orders bigint")
    assert values(reports.order_frequency(mart)) == [
        ("1 order", 1), ("2-3 orders", 2), ("4+ orders", 2)
    ]


def test_average_order_value_skips_customers_without_orders(spark):
    mart = spark.createDataFrame(
        [(1, "a", 0, 0.0), (2, "b", 2, 3.01), (3, "c", 4, 10.0)],
        "customer_id bigint, customer_name string, total_orders bigint, total_spent double",
    )
    rows = reports.avg_order_value(mart).select("customer_name", "avg_order_value").collect()
    assert [tuple(r) for r in rows] == [("c", 2.5), ("b", 1.51)]


def test_top_rows_need_no_full_sort(spark, sf):
    mart = build_models(spark, sf)["customer_orders"]
    assert "TakeOrderedAndProject" in plan(reports.top_customers(mart))
    assert "rangepartitioning" in plan(reports.customers_by_spend(mart))
    assert operators(reports.top_customers(mart), "CartesianProduct") == 0


def test_ties_are_ordered_by_key(spark):
    mart = spark.createDataFrame(
        [(i, f"c{i}", "S", 1, 5.0, 0, 0, None, None) for i in (3, 1, 2)],
        "customer_id bigint, customer_name string, market_segment string, total_orders bigint, "
        "total_spent double, open_orders bigint, fulfilled_orders bigint, "
        "first_order_date date, last_order_date date",
    )
    assert [r.customer_name for r in reports.top_customers(mart, 2).collect()] == ["c1", "c2"]


def test_money_and_rounding(spark):
    got = spark.createDataFrame([(0.125,), (1.005,), (-2.5,), (None,)], "x double").select(
        money_text(F.col("x")), round_to(F.col("x"), 2)
    )
    assert [tuple(r) for r in got.collect()] == [
        ("$0.13", 0.13), ("$1.01", 1.01), ("$-2.50", -2.5), (None, None)
    ]


@pytest.mark.parametrize("steps, value, status", [
    (SUCCESS_RATE_STEPS, 79.9, "red"), (SUCCESS_RATE_STEPS, 80.0, "yellow"),
    (SUCCESS_RATE_STEPS, 95.0, "green"), (SUCCESS_RATE_STEPS, None, None),
    (SNAPSHOT_AGE_STEPS, 299.0, "green"), (SNAPSHOT_AGE_STEPS, 300.0, "yellow"),
    (SNAPSHOT_AGE_STEPS, 3600.0, "red"), (FAILED_RUNS_STEPS, 0.0, "green"),
    (FAILED_RUNS_STEPS, 1.0, "red"), (PENDING_FILES_STEPS, 1.0, "red"),
])
def test_threshold_boundaries(spark, steps, value, status):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(threshold_status(F.col("x"), steps)).first()[0] == status
