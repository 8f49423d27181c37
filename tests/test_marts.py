from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import pytest
from hypothesis import given as given_values
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import CUSTOMERS, LINES, ORDERS, assert_model, given, operators, plan, values

from tidemart.functions import exact_sum, round_to
from tidemart.operators.marts import customer_orders, order_revenue
from tidemart.operators.staging import stg_customers, stg_lineitem, stg_orders
from tidemart.plans.models import build_models

ALICE = {
    "customer_id": 1, "customer_name": "Alice", "phone": "555-0100",
    "market_segment": "BUILDING", "account_balance": 1000.0, "nation_key": 1,
}


def test_customer_without_orders(spark):
    inputs = [given(spark, CUSTOMERS, ALICE), given(spark, ORDERS)]
    assert_model(customer_orders, inputs, [{
        "customer_id": 1, "customer_name": "Alice", "total_orders": 0, "total_spent": 0.0,
        "open_orders": 0, "fulfilled_orders": 0, "first_order_date": None,
        "last_order_date": None,
    }])


def test_orders_are_counted_by_status(spark):
    day = dt.date
    orders = given(
        spark, ORDERS,
        {"order_id": 1, "customer_id": 1, "order_date": day(1994, 1, 10),
         "order_amount": 1000.0, "order_status": "F"},
        {"order_id": 2, "customer_id": 1, "order_date": day(1995, 3, 5),
         "order_amount": 500.0, "order_status": "O"},
        {"order_id": 3, "customer_id": 1, "order_date": day(1996, 3, 5),
         "order_amount": 0.1, "order_status": "P"},
        {"order_id": 4, "customer_id": None, "order_amount": 7.0, "order_status": "O"},
    )
    assert_model(customer_orders, [given(spark, CUSTOMERS, ALICE), orders], [{
        "customer_id": 1, "total_orders": 3, "total_spent": 1500.1, "open_orders": 1,
        "fulfilled_orders": 1, "first_order_date": day(1994, 1, 10),
        "last_order_date": day(1996, 3, 5),
    }])


def test_order_without_lines_keeps_nulls_and_zero_quantity_has_no_unit_price(spark):
    orders = given(spark, ORDERS, {"order_id": 1, "order_amount": 5.0}, {"order_id": 2},
                   {"order_id": 3})
    lines = given(
        spark, LINES,
        {"order_id": 2, "quantity": 0.0, "net_price": 10.0, "gross_price": 11.0,
         "return_flag": "N"},
        {"order_id": 3, "quantity": 2.0, "net_price": 1.0, "gross_price": 2.0,
         "return_flag": "R"},
        {"order_id": 3, "quantity": 4.0, "net_price": 3.0, "gross_price": 4.0,
         "return_flag": "A"},
        {"order_id": 3, "quantity": 1.0, "net_price": 3.0, "gross_price": 4.0},
    )
    columns = ["order_id", "net_revenue", "line_count", "returned_lines",
               "avg_net_price_per_unit", "return_rate_pct"]
    assert values(order_revenue(orders, lines), *columns) == [
        (1, None, None, None, None, None),
        (2, 10.0, 1, 0, None, 0.0),
        (3, 7.0, 3, 1, 1.0, 33.33),
    ]


def test_duplicate_customers_are_kept(spark):
    customers = given(spark, CUSTOMERS, ALICE, ALICE)
    orders = given(spark, ORDERS, {"order_id": 1, "customer_id": 1, "order_amount": 2.0})
    assert customer_orders(customers, orders).count() == 2


def total(df):
    return df.agg(exact_sum(df, "x")).first()[0]


def test_sums_keep_small_amounts(spark):
    customers = given(spark, CUSTOMERS, *[{**ALICE, "customer_id": i} for i in range(3)])
    orders = given(spark, ORDERS, *[{"order_id": i, "customer_id": i, "order_amount": 0.004} for i in range(3)])
    assert [r.total_spent for r in customer_orders(customers, orders).collect()] == [0.004] * 3


def test_exact_sum_of_doubles_and_decimals(spark):
    mixed = spark.createDataFrame([(-0.07,), (12345678.91,), (None,), (-0.0,)], "x double")
    assert total(mixed) == math.fsum([-0.07, 12345678.91])
    assert total(mixed.where("x > 1e9")) is None
    assert total(mixed.where("x is null")) is None
    decimals = spark.createDataFrame([(Decimal("0.10"),)] * 3, "x decimal(15,2)")
    assert total(decimals) == Decimal("0.30")
    assert total(spark.range(5).select(F.col("id").cast("int").alias("x"))) == 10


AMOUNTS = st.one_of(st.integers(-10**7, 10**7).map(lambda i: i / 100), st.floats(-1e3, 1e3).filter(lambda x: x == 0 or abs(x) > 1e-3))


@given_values(st.lists(AMOUNTS, min_size=1, max_size=40), st.randoms())
@settings(max_examples=12, deadline=None)
def test_exact_sum_in_any_order(spark, values, dice):
    """The nearest double or its neighbour, and the same bits for every order and partitioning."""
    once = total(spark.createDataFrame([(x,) for x in values], "x double").coalesce(1))
    dice.shuffle(values)
    again = total(spark.createDataFrame([(x,) for x in values], "x double").repartition(5))
    assert once == again
    assert once == pytest.approx(math.fsum(values), rel=3e-16, abs=1e-13)


@pytest.mark.parametrize("values", [
    [1e16, 1.0, -1e16], [1e18, -1e18, 0.004], [-0.004, -0.001], [-5e17, 2.5], [2.0**60, 2.0**-60, -2.0**60], [1e-30],
    [-(2.0**61)] * 9, [0.1] * 1000])
def test_exact_sum_is_exact(spark, values):
    found = total(spark.createDataFrame([(x,) for x in values], "x double"))
    assert found == (0.0 if values == [1e-30] else pytest.approx(math.fsum(values), rel=3e-16))


@pytest.mark.parametrize("value, count, wanted", [
    (0.004, 1000, 4.0), (float("inf"), 2, float("inf")), (float("-inf"), 1, float("-inf")), (1e19, 3, 3e19)])
def test_sums_are_not_cut(spark, value, count, wanted):
    assert total(spark.range(count).select(F.lit(value).alias("x"))) == wanted


def test_sum_with_not_a_number(spark):
    assert math.isnan(total(spark.createDataFrame([(1.0,), (float("nan"),)], "x double")))
    assert math.isnan(total(spark.createDataFrame([(float("inf"),), (float("-inf"),)], "x double")))


def test_floats_are_summed_as_doubles(spark):
    floats = spark.createDataFrame([(0.5,), (1.25,)], "x float")
    assert total(floats) == 1.75


def test_rounding_has_no_bound(spark):
    large = spark.range(1).select(F.lit(1e29).alias("x"), F.lit(float("nan")).alias("y"))
    assert large.select(round_to(F.col("x"), 2)).first()[0] == 1e29
    assert large.select(F.isnan(round_to(F.col("y"), 2))).first()[0]


def test_staging_renames_and_fills_missing_columns(spark):
    raw = spark.createDataFrame([(1, "A", "addr")], "c_custkey bigint, c_name string, "
                                "c_address string")
    staged = stg_customers(raw, "2024-01-01 00:00:00")
    assert staged.columns == ["customer_id", "customer_name", "phone", "address",
                              "account_balance", "market_segment", "nation_key", "_loaded_at"]
    row = staged.first()
    assert (row.address, row.phone) == ("addr", None)
    assert row._loaded_at == dt.datetime(2024, 1, 1)
    assert stg_orders(spark.createDataFrame([(1,)], "o_orderkey bigint")).count() == 1


def test_line_prices(spark):
    raw = spark.createDataFrame(
        [(1, 100.0, 0.1, 0.05)],
        "l_orderkey bigint, l_extendedprice double, l_discount double, l_tax double",
    )
    row = stg_lineitem(raw).first()
    assert (row.net_price, round(row.gross_price, 6)) == (90.0, 94.5)


def test_only_needed_columns_are_scanned(spark, sf):
    counts = build_models(spark, sf)["order_revenue"].select("order_id", "line_count")
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan(counts)
    # A left join whose right side is not used disappears.
    assert operators(build_models(spark, sf)["customer_orders"].select("customer_id"),
                     "Exchange") == 0


def test_marts_shuffle_each_side_once(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart in ("customer_orders", "order_revenue"):
            assert operators(build_models(spark, sf)[mart], "Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
