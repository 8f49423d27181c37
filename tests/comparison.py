"""Compare a Spark result with the SQL result on DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def plain(value):
    """One form per value, so that both engines print it the same."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return value


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Readable differences in columns, types, row counts and values."""
    result = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(result.columns):
        return [f"columns {names} != {sorted(result.columns)}"]
    found = []
    types = dict(zip(result.columns, map(str, result.types)))
    for field in df.schema:
        kind = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != types[field.name]:
            found.append(f"type of {field.name}: {kind} != {types[field.name]}")
    spark_rows = df.select(*[f"`{name}`" for name in names]).collect()
    duck_rows = result.select(*[duckdb.ColumnExpression(name) for name in names]).fetchall()
    left = Counter(tuple(map(plain, row)) for row in spark_rows)
    right = Counter(tuple(map(plain, row)) for row in duck_rows)
    if len(spark_rows) != len(duck_rows):
        found.append(f"rows {len(spark_rows)} != {len(duck_rows)}")
    if left != right:
        only_left, only_right = left - right, right - left
        found.append(f"{sum(only_left.values())} rows differ; spark {list(only_left)[:2]} "
                     f"sql {list(only_right)[:2]} columns {names}")
    return found
