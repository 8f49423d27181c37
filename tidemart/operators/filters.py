"""Predicates; each compares a bare column with a constant, so it reaches the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.times import Instant, instant_like


def live_rows(df: DataFrame, end_column: str = "end_snapshot") -> DataFrame:
    """Rows of a versioned table that no later snapshot has ended."""
    return df.where(F.col(end_column).isNull())


def since_interval(df: DataFrame, column: str, as_of: Instant, interval: str) -> DataFrame:
    """Rows not older than an interval such as ``1 hour`` or ``7 days``."""
    bound = instant_like(df, column, as_of) - F.expr(f"INTERVAL {interval}")
    return df.where(F.col(column) >= bound)


def rolling_reprocess_window(
    df: DataFrame, run_date: Instant, days: int = 7, column: str = "event_date"
) -> DataFrame:
    """Rows whose date lies at most ``days`` before the run."""
    return df.where(F.col(column) >= F.date_sub(F.lit(str(run_date)).cast("date"), days))


def time_range(df: DataFrame, column: str, start: Instant, end: Instant) -> DataFrame:
    """Rows inside a dashboard's time range, both ends included."""
    return df.where(
        F.col(column).between(instant_like(df, column, start), instant_like(df, column, end))
    )


def state_equals(df: DataFrame, state: str, column: str = "state") -> DataFrame:
    return df.where(F.col(column) == state)


def state_in(df: DataFrame, *states: str, column: str = "state") -> DataFrame:
    return df.where(F.col(column).isin(*states))


def is_not_null(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def between_dates_and_key(
    df: DataFrame,
    start: Instant,
    end: Instant,
    key_value: str,
    column: str = "event_date",
    key: str = "artist_id",
) -> DataFrame:
    """A date range of one key; on a partitioned table only those folders are read."""
    return time_range(df, column, start, end).where(F.col(key) == key_value)


def min_orders(df: DataFrame, more_than: int, column: str = "total_orders") -> DataFrame:
    return df.where(F.col(column) > more_than)


def label_nonempty(df: DataFrame, label: str = "name") -> DataFrame:
    """Series whose label is set and not empty."""
    return df.where(F.col("labels")[label] != "")


def positive_limit(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def prefix_like(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose text starts with a literal prefix."""
    return df.where(F.col(column).startswith(prefix))
