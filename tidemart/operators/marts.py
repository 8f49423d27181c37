"""Customer and order marts: aggregate on the join key first, then join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import exact_sum, percent, ratio, round_to


def customer_order_summary(orders: DataFrame) -> DataFrame:
    """One row per customer that has orders.

    Every aggregate combines map-side, so a customer with a third of all orders
    reaches the shuffle as one row per task. Partial orders ('P') count in the
    totals but are neither open nor fulfilled.
    """
    status = F.col("order_status")
    return orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        exact_sum(orders, "order_amount").alias("total_spent"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count_if(status == "O").alias("open_orders"),
        F.count_if(status == "F").alias("fulfilled_orders"),
    )


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer; without orders the numbers are 0 and the dates NULL."""
    zero = {"total_orders": 0, "total_spent": 0.0, "open_orders": 0, "fulfilled_orders": 0}
    return (
        customers.join(customer_order_summary(orders), "customer_id", "left")
        .select(
            "customer_id", "customer_name", "phone", "market_segment", "account_balance",
            *[F.coalesce(name, F.lit(value)).alias(name) for name, value in zero.items()],
            "first_order_date", "last_order_date",
        )
    )


def revenue_by_order(lines: DataFrame) -> DataFrame:
    """One row per order that has line items."""
    return lines.groupBy("order_id").agg(
        exact_sum(lines, "net_price").alias("net_revenue"),
        exact_sum(lines, "gross_price").alias("gross_revenue"),
        exact_sum(lines, "quantity").alias("total_quantity"),
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("return_flag") == "R").alias("returned_lines"),
    )


def order_revenue(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order; without line items every revenue column stays NULL."""
    per_unit = ratio(F.col("net_revenue"), F.col("total_quantity"))
    return orders.join(revenue_by_order(lines), "order_id", "left").select(
        "order_id", "customer_id", "order_date", "order_status", "order_priority", "clerk",
        F.col("order_amount").alias("list_price"),
        "net_revenue", "gross_revenue", "total_quantity", "line_count", "returned_lines",
        round_to(per_unit, 2).alias("avg_net_price_per_unit"),
        percent(F.col("returned_lines"), F.col("line_count"), 2).alias("return_rate_pct"),
    )
