"""Given rows in, expected rows out."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CUSTOMERS = (
    "customer_id bigint, customer_name string, phone string, address string, "
    "account_balance double, market_segment string, nation_key int"
)
ORDERS = (
    "order_id bigint, customer_id bigint, order_amount double, order_date date, "
    "order_status string, order_priority string, clerk string"
)
LINES = (
    "order_id bigint, line_number int, quantity double, extended_price double, "
    "discount double, tax double, net_price double, gross_price double, return_flag string"
)


def given(spark: SparkSession, schema: str, *rows: dict) -> DataFrame:
    """Rows as dicts; a column that a row leaves out is NULL."""
    columns = StructType.fromDDL(schema)
    return spark.createDataFrame(
        [tuple(row.get(field.name) for field in columns) for row in rows], columns
    )


def write_events(spark: SparkSession, folder, *rows: tuple) -> None:
    """A table of events from (minute of 5 January 2024, user, type, value, k)."""
    start = dt.datetime(2024, 1, 5)
    spark.createDataFrame(
        [(i, start + dt.timedelta(minutes=minute), user, kind, value, f'{{"k": {k}}}')
         for i, (minute, user, kind, value, k) in enumerate(rows)],
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    ).write.parquet(f"{folder}/events.parquet")


def values(df: DataFrame, *columns: str) -> list[tuple]:
    """Sorted rows of some columns."""
    names = columns or df.columns
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)


def assert_model(model, inputs: list[DataFrame], expected: list[dict]) -> None:
    """A model over given inputs has the expected rows, compared on the named columns."""
    columns = list(expected[0])
    got = values(model(*inputs), *columns)
    want = sorted((tuple(row[c] for c in columns) for row in expected), key=repr)
    assert got == want


def plan(df: DataFrame) -> str:
    """The physical plan; the final one once the query has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def operators(df: DataFrame, word: str) -> int:
    return len(re.findall(rf"\b{word}\b", plan(df)))
