"""Declared tables: columns, types and the contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Raw column -> (model column, type used when the source lacks the column).
CUSTOMER_COLUMNS = {
    "c_custkey": ("customer_id", "bigint"),
    "c_name": ("customer_name", "string"),
    "c_phone": ("phone", "string"),
    "c_address": ("address", "string"),
    "c_acctbal": ("account_balance", "double"),
    "c_mktsegment": ("market_segment", "string"),
    "c_nationkey": ("nation_key", "int"),
}
ORDER_COLUMNS = {
    "o_orderkey": ("order_id", "bigint"),
    "o_custkey": ("customer_id", "bigint"),
    "o_totalprice": ("order_amount", "double"),
    "o_orderdate": ("order_date", "timestamp_ntz"),
    "o_orderstatus": ("order_status", "string"),
    "o_orderpriority": ("order_priority", "string"),
    "o_clerk": ("clerk", "string"),
}
LINE_COLUMNS = {
    "l_orderkey": ("order_id", "bigint"),
    "l_linenumber": ("line_number", "int"),
    "l_quantity": ("quantity", "double"),
    "l_extendedprice": ("extended_price", "double"),
    "l_discount": ("discount", "double"),
    "l_tax": ("tax", "double"),
    "l_returnflag": ("return_flag", "string"),
    "l_linestatus": ("line_status", "string"),
    "l_shipdate": ("ship_date", "timestamp_ntz"),
    "l_commitdate": ("commit_date", "timestamp_ntz"),
    "l_shipmode": ("ship_mode", "string"),
}

# Columns of the two seed files.
SEED_CUSTOMERS = "customer_id int, customer_name string, email string, created_at date"
SEED_ORDERS = "order_id int, customer_id int, order_date date, order_amount decimal(18,2)"

# Canonical platform fact: one row per date, artist, track and source.
FACT_DDL = (
    "event_date date, artist_id string, track_id string, streams bigint, "
    "revenue decimal(38,9), source string, updated_at timestamp"
)
FACT_KEYS = ("event_date", "artist_id", "track_id", "source")
FACT_MEASURES = ("streams", "revenue", "updated_at")
FACT_CLUSTER = ("artist_id", "source", "track_id")
DASHBOARD_CLUSTER = ("artist_id", "source")

SAMPLE_DDL = "metric string, labels map<string,string>, ts timestamp, value double"


def contract_report(name: str, df: DataFrame, expected: StructType | str) -> DataFrame:
    """One row for each column that an input should have or has: what is expected, what is there, and how much is filled.

    ``place`` is where the column should stand; ``ok`` that it stands there with the
    declared type. A missing column has nothing filled, an extra one no place.
    """
    wanted = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    have = {field.name: (place, field.dataType.simpleString()) for place, field in enumerate(df.schema, 1)}
    want = {field.name: (place, field.dataType.simpleString()) for place, field in enumerate(wanted, 1)}
    filled = df.agg(*[F.count(F.col(f"`{column}`")).alias(f"n{place}") for column, (place, _) in have.items()]
                    or [F.lit(0).alias("none")])
    cells = []
    for column in [*want, *[extra for extra in have if extra not in want]]:
        place, kind = want.get(column, (None, None))
        found_place, found = have.get(column, (None, None))
        cells.append(F.struct(
            F.lit(name).alias("input"), F.lit(column).alias("column"), F.lit(place).cast("int").alias("place"),
            F.lit(kind).cast("string").alias("expected"), F.lit(found).cast("string").alias("found"),
            (F.col(f"n{found_place}") if found_place else F.lit(0)).cast("bigint").alias("filled"),
            F.lit((place, kind) == (found_place, found)).alias("ok")))
    return filled.select(F.inline(F.array(*cells)))


class ContractError(ValueError):
    """A DataFrame does not have the declared columns, order and types."""


def check_contract(df: DataFrame, expected: StructType | str) -> DataFrame:
    """Compare names, order and types (not nullability); metadata only, no job."""
    wanted = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    have = [(field.name, field.dataType.simpleString()) for field in df.schema]
    want = [(field.name, field.dataType.simpleString()) for field in wanted]
    if have != want:
        raise ContractError(f"expected {want}, found {have}")
    return df
