"""Instants, durations and buckets for TIMESTAMP and TIMESTAMP_NTZ columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

Instant = str | dt.datetime | dt.date | None


def instant(as_of: Instant, kind: str | DataType = "timestamp") -> Column:
    """Literal of the wanted type; ``None`` means the current time."""
    if as_of is None:
        return F.current_timestamp().cast(kind)
    return F.lit(str(as_of)).cast(kind)


def instant_like(df: DataFrame, name: str, as_of: Instant) -> Column:
    """Literal with the type of a column, so that comparisons reach the scan."""
    return instant(as_of, df.schema[name].dataType)


def micros(column: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(column.cast("timestamp"))


def epoch_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two instants, with fraction."""
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def hour_bucket(df: DataFrame, name: str) -> Column:
    """Start of the hour, in the type of the column."""
    return F.date_trunc("hour", F.col(name)).cast(df.schema[name].dataType)
