"""Reporting queries over the marts.

The order of rows with equal sort values is fixed by the primary key. Money is
turned into text after the sort and the limit, so only shown rows pay for it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import exact_avg, exact_sum, money_text, ratio, round_to
from tidemart.operators.filters import min_orders
from tidemart.operators.joins import join_inner_customer
from tidemart.operators.marts import order_revenue, revenue_by_order


def _take(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """Sorted rows; with ``n`` a per-task top-n merged at the end, no full sort."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def _by_spend(customer_orders: DataFrame, n: int | None) -> DataFrame:
    best = _take(customer_orders, n, F.desc_nulls_last("total_spent"), F.asc("customer_id"))
    return best.withColumn("total_spent", money_text(F.col("total_spent")))


def top_customers(customer_orders: DataFrame, n: int = 20) -> DataFrame:
    """The customers with the highest spend."""
    return _by_spend(customer_orders, n).select(
        "customer_name", "market_segment", "total_orders", "total_spent", "open_orders",
        "fulfilled_orders", "first_order_date", "last_order_date",
    )


def customers_by_spend(customer_orders: DataFrame, n: int | None = None) -> DataFrame:
    """The short form of the same ranking; without ``n`` it lists every customer."""
    return _by_spend(customer_orders, n).select(
        "customer_name", "total_orders", "total_spent", "first_order_date", "last_order_date"
    )


def order_statistics(customer_orders: DataFrame) -> DataFrame:
    """One row of totals over all customers."""
    spend = {
        "total_revenue": exact_sum(customer_orders, "total_spent"),
        "avg_customer_value": exact_avg(customer_orders, "total_spent"),
        "min_customer_value": F.min("total_spent"),
        "max_customer_value": F.max("total_spent"),
    }
    return customer_orders.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("total_orders").alias("total_orders"),
        *[value.alias(name) for name, value in spend.items()],
    ).withColumns({name: money_text(F.col(name)) for name in spend})


def _newest_first() -> tuple[Column, Column]:
    return F.desc_nulls_last("order_date"), F.asc("order_id")


def _recent_columns(latest: DataFrame) -> DataFrame:
    return latest.select(
        "order_id", "customer_name", "market_segment", "order_priority",
        money_text(F.col("list_price")).alias("list_price"),
        money_text(F.col("net_revenue")).alias("net_revenue"),
        "line_count", "returned_lines", "order_date",
    )


def recent_orders(revenue: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """Latest orders with their revenue, from a saved revenue mart."""
    return _recent_columns(_take(join_inner_customer(revenue, customers), n, *_newest_first()))


# Keys up to this number go into the filter of the scan; more are joined.
LISTED_KEYS = 1000


def recent_orders_live(
    orders: DataFrame, lines: DataFrame, customers: DataFrame, n: int = 10
) -> DataFrame:
    """The same rows when the mart is not saved.

    The latest ``n`` orders are found first, without touching the line items,
    and are kept: ``n`` rows at most. Their keys then stand as constants in the
    filter of the scan of the line items, so that files and row groups without
    any of them are skipped, and each table is read once.
    """
    spark = orders.sparkSession
    latest = _take(join_inner_customer(orders, customers), n, *_newest_first())
    kept = spark.createDataFrame(latest.toArrow(), latest.schema)
    if n <= LISTED_KEYS:
        keys = [row.order_id for row in kept.select("order_id").collect() if row.order_id is not None]
        wanted = lines.where(F.col("order_id").isin(keys))
    else:
        wanted = lines.join(kept.select("order_id"), "order_id", "left_semi")
    with_revenue = kept.join(revenue_by_order(wanted), "order_id", "left")
    return _recent_columns(
        with_revenue.withColumnRenamed("order_amount", "list_price").orderBy(*_newest_first())
    )


def recent_orders_basic(orders: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """Latest orders with the customer's name, from staging only."""
    return _take(join_inner_customer(orders, customers), n, *_newest_first()).select(
        "order_id", "customer_name", money_text(F.col("order_amount")).alias("amount"),
        "order_date",
    )


def revenue_by_segment(revenue: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, revenue and mean return rate per market segment, by revenue.

    Orders are first reduced to one row per customer. The join with customers
    then moves one row per customer and a dominant customer causes no skew.
    Means are divided only at the end, so the result equals the plain one.
    """
    per_customer = revenue.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        exact_sum(revenue, "net_revenue").alias("net"),
        F.count("net_revenue").alias("net_n"),
        exact_sum(revenue, "return_rate_pct").alias("rate"),
        F.count("return_rate_pct").alias("rate_n"),
    )
    joined = per_customer.join(
        customers.select("customer_id", "market_segment"), "customer_id", "inner"
    )
    return (
        joined.groupBy("market_segment")
        .agg(
            F.sum("orders").alias("total_orders"),
            exact_sum(joined, "net").alias("net"),
            F.sum("net_n").alias("net_n"),
            exact_sum(joined, "rate").alias("rate"),
            F.sum("rate_n").alias("rate_n"),
        )
        .orderBy(F.desc_nulls_last("net"), F.asc("market_segment"))
        .select(
            "market_segment",
            "total_orders",
            money_text(F.col("net")).alias("net_revenue"),
            money_text(ratio(F.col("net"), F.col("net_n"))).alias("avg_order_revenue"),
            round_to(ratio(F.col("rate"), F.col("rate_n")), 2).alias("avg_return_rate_pct"),
        )
    )


def order_frequency(customer_orders: DataFrame) -> DataFrame:
    """Customers per order-count bucket.

    The last bucket takes everything that is not 1, 2 or 3, also a customer
    with no orders at all; that is the defined answer.
    """
    orders = F.col("total_orders")
    bucket = (
        F.when(orders == 1, "1 order")
        .when(orders.between(2, 3), "2-3 orders")
        .otherwise("4+ orders")
    )
    return customer_orders.groupBy(bucket.alias("order_frequency")).agg(
        F.count(F.lit(1)).alias("customer_count")
    )


def avg_order_value(customer_orders: DataFrame) -> DataFrame:
    """Mean order value of every customer that has orders, by total spend."""
    mean = ratio(F.col("total_spent"), F.col("total_orders"))
    return (
        min_orders(customer_orders, 0)
        .orderBy(F.desc_nulls_last("total_spent"), F.asc("customer_id"))
        .select(
            "customer_name", "total_orders", "total_spent",
            round_to(mean, 2).alias("avg_order_value"),
        )
    )


def raw_orders(seed: DataFrame) -> DataFrame:
    """Seed orders with money text, newest first."""
    return seed.orderBy(F.desc_nulls_last("order_date"), F.asc("order_id")).select(
        "order_id", "customer_id", money_text(F.col("order_amount")).alias("amount"),
        "order_date",
    )


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, all in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
