"""Typed staging models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import gross_price, instant, net_price, safe_cast, typed_null
from tidemart.functions.times import Instant
from tidemart.schemas import (
    CUSTOMER_COLUMNS,
    FACT_DDL,
    LINE_COLUMNS,
    ORDER_COLUMNS,
    check_contract,
)


def _staged(
    df: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    as_of: Instant,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Renamed source columns, ``derived`` ones, and the load time.

    A column that the source lacks becomes a typed NULL.
    """
    present = set(df.columns)
    renamed = df.selectExpr(
        *[
            f"`{raw}` AS {name}" if raw in present else f"CAST(NULL AS {kind}) AS {name}"
            for raw, (name, kind) in columns.items()
        ]
    )
    return renamed.withColumns({**(derived or {}), "_loaded_at": instant(as_of)})


def stg_customers(customer: DataFrame, loaded_at: Instant = None) -> DataFrame:
    return _staged(customer, CUSTOMER_COLUMNS, loaded_at)


def stg_orders(orders: DataFrame, loaded_at: Instant = None) -> DataFrame:
    return _staged(orders, ORDER_COLUMNS, loaded_at)


def stg_lineitem(lineitem: DataFrame, loaded_at: Instant = None) -> DataFrame:
    """Line items with the net (discounted) and gross (taxed) price of each line."""
    price, discount, tax = map(F.col, ("extended_price", "discount", "tax"))
    prices = {
        "net_price": net_price(price, discount),
        "gross_price": gross_price(price, discount, tax),
    }
    return _staged(lineitem, LINE_COLUMNS, loaded_at, prices)


# Canonical column -> source column. A source without revenue leaves it out.
SOURCE_A = {
    "event_date": "stream_date",
    "artist_id": "artist_id",
    "track_id": "track_id",
    "streams": "streams",
}
SOURCE_B = {
    "event_date": "report_date",
    "artist_id": "channel_artist_id",
    "track_id": "video_track_id",
    "streams": "views",
    "revenue": "estimated_revenue",
}


def stg_platform(df: DataFrame, mapping: Mapping[str, str], source: str) -> DataFrame:
    """Bring one platform to the canonical fact columns, tagged with its name.

    Revenue is cast safely, because platforms report it as text; a platform
    that reports none gets a typed NULL.
    """
    revenue = mapping.get("revenue")
    staged = df.select(
        F.to_date(F.col(mapping["event_date"])).alias("event_date"),
        F.col(mapping["artist_id"]).cast("string").alias("artist_id"),
        F.col(mapping["track_id"]).cast("string").alias("track_id"),
        F.col(mapping["streams"]).cast("bigint").alias("streams"),
        (
            safe_cast(F.col(revenue), "decimal(38,9)") if revenue else typed_null("decimal(38,9)")
        ).alias("revenue"),
        F.lit(source).alias("source"),
        F.col(mapping.get("updated_at", "updated_at")).cast("timestamp").alias("updated_at"),
    )
    return check_contract(staged, FACT_DDL)


def pack_extra(df: DataFrame, canonical: Iterable[str]) -> DataFrame:
    """Keep the canonical columns and move all others into one JSON column."""
    keep = [name for name in df.columns if name in set(canonical)]
    rest = [name for name in df.columns if name not in set(canonical)]
    extra = F.to_json(F.struct(*rest)) if rest else typed_null("string")
    return df.select(*keep, extra.alias("extra"))
