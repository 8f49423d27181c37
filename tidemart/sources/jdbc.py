"""Catalog and run-log tables in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: object | None = None,
    upper: object | None = None,
    partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options; a partitioned read needs its column, bounds and count.

    Bounds only set the stride: rows outside them still arrive, in the first
    or the last partition.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_SIZE), **extra}
    split = (partition_column, lower, upper, partitions)
    if any(part is not None for part in split):
        if any(part is None for part in split):
            raise ValueError("partition_column, lower, upper and partitions go together")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Read a table; Spark pushes filters, columns and aggregates to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
