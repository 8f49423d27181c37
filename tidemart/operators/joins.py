"""Join shapes shared by the reports and the quality checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_left(left: DataFrame, reduced: DataFrame, key: str) -> DataFrame:
    """LEFT OUTER with a side already reduced to one row per key."""
    return left.join(reduced, key, "left")


def join_inner_customer(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """INNER on customer_id: rows without a customer vanish.

    Adaptive execution splits the partition of a customer that dominates.
    """
    names = customers.select("customer_id", "customer_name", "market_segment")
    return facts.join(names, "customer_id", "inner")


def anti_join_orphans(child: DataFrame, key: str, parent: DataFrame, pkey: str) -> DataFrame:
    """Non-null child keys with no parent, and how many rows carry each.

    The child is reduced to one row per key before the join, so a hot key
    costs one row per task; the join reuses that partitioning.
    """
    keys = (
        child.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    parents = parent.select(F.col(pkey).alias("parent_key"))
    return keys.join(parents, F.col("orphan_key") == F.col("parent_key"), "left_anti")


def correlated_child_count(
    parent: DataFrame, child: DataFrame, key: str, child_key: str | None = None
) -> DataFrame:
    """Each parent row with the number of its children, 0 when it has none."""
    counts = child.groupBy(F.col(child_key or key).alias(key)).agg(
        F.count(F.lit(1)).alias("_children")
    )
    return (
        parent.join(counts, key, "left")
        .withColumn("child_count", F.coalesce("_children", F.lit(0)))
        .drop("_children")
    )


def combine_grains(daily: DataFrame, monthly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Facts of different grain, reduced to month and artist, then combined.

    ``daily`` has event_date, artist_id and streams; ``monthly`` has month,
    artist_id and revenue. Joining before the reduction would repeat the
    monthly value on every day.
    """
    by_day = (
        daily.withColumn("month", F.trunc("event_date", "month"))
        .groupBy(*keys)
        .agg(F.sum("streams").alias("streams"))
    )
    by_month = monthly.groupBy(*keys).agg(F.sum("revenue").alias("revenue"))
    return by_day.join(by_month, list(keys), "full")
