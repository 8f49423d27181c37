"""The dates of a partitioned table, kept beside it, so that a reader lists only the folders it wants.

The index is one small Parquet file in a folder of the table whose name Spark
skips. A write first leaves a mark, then writes, then replaces the index, which
takes the mark away. An index that is absent or marked (a write is under way, or
one has failed) is not trusted: the reader lists the whole table instead,
and ``rebuild`` makes a new index from such a listing. Rows written by anything else
need a ``rebuild`` too. There is one writer at a time, as for the table itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FOLDER = "_dates"
ENTRIES = "day date, state string"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
EPOCH = dt.date(1970, 1, 1)
MAP_DAYS = 1 << 15  # the days of one bitmap, 1970-01-02 to 2059-09-19


@dataclass(frozen=True)
class Dates:
    """The dates a table has, and whether it has rows without one."""

    days: frozenset[dt.date] = frozenset()
    none: bool = False

    def __or__(self, other: Dates) -> Dates:
        return Dates(self.days | other.days, self.none or other.none)


def observed(df: DataFrame, partition: str) -> tuple[DataFrame, Observation]:
    """``df`` that notes its dates while it is written: one bit a day, so no second scan."""
    seen, day = Observation(), F.unix_date(partition)
    return df.observe(
        seen, F.hex(F.bitmap_construct_agg(F.bitmap_bit_position(day))).alias("bits"), F.min(day).alias("low"),
        F.max(day).alias("high"), F.count_if(F.col(partition).isNull()).alias("nulls")), seen


def dates_of(seen: Observation, df: DataFrame, partition: str) -> Dates:
    """What was noted. Days beyond the bitmap are looked up in ``df``."""
    found = seen.get
    none, low, high = found["nulls"] > 0, found["low"], found["high"]
    if low is None:
        return Dates(none=none)
    if low < 1 or high > MAP_DAYS:
        rows = df.select(F.col(partition).alias("day")).where("day is not null").distinct().collect()
        return Dates(frozenset(row.day for row in rows), none)
    bits = int.from_bytes(bytes.fromhex(found["bits"]), "little")
    return Dates(frozenset(EPOCH + dt.timedelta(days=day) for day in range(low, high + 1) if bits >> (day - 1) & 1), none)


def _entries(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(ENTRIES).parquet(f"{path}/{FOLDER}")
    except AnalysisException:
        return None


def read(spark: SparkSession, path: str, wanted: Column | None = None) -> Dates | None:
    """The dates that ``wanted`` (a condition on ``day``) selects, at most one row a day; None if they are not known."""
    entries = _entries(spark, path)
    if entries is None:
        return None
    state = F.col("state")
    rows = entries.where((state != "day") | wanted if wanted is not None else F.lit(True)).collect()
    states = {row.state for row in rows}
    if "whole" not in states or "open" in states:
        return None
    return Dates(frozenset(row.day for row in rows if row.state == "day"), "none" in states)


def _write(spark: SparkSession, path: str, rows: Iterable[tuple], mode: str) -> None:
    spark.createDataFrame(list(rows), ENTRIES).coalesce(1).write.mode(mode).parquet(f"{path}/{FOLDER}")


def mark(spark: SparkSession, path: str) -> None:
    """From now on the index is not trusted, until it is replaced."""
    if _entries(spark, path) is not None:
        _write(spark, path, [(None, "open")], "append")


def replace(spark: SparkSession, path: str, dates: Dates) -> None:
    states = ["whole", *(["none"] if dates.none else [])]
    _write(spark, path, [(None, s) for s in states] + [(day, "day") for day in sorted(dates.days)], "overwrite")


def listed(spark: SparkSession, path: str, partition: str, schema: str | StructType | None) -> Dates:
    """The dates that a listing of the whole table shows."""
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(path).select(F.col(partition).cast("date").alias("day")).distinct().collect()
    return Dates(frozenset(row.day for row in rows if row.day is not None), any(row.day is None for row in rows))


def rebuild(spark: SparkSession, path: str, partition: str = "event_date",
            schema: str | StructType | None = None) -> Dates:
    """A new index from a listing, after a failed write or rows written by something else."""
    mark(spark, path)
    dates = listed(spark, path, partition, schema)
    replace(spark, path, dates)
    return dates


def folders(path: str, partition: str, dates: Dates) -> list[str]:
    names = [str(day) for day in sorted(dates.days)] + ([NULL_FOLDER] if dates.none else [])
    return [f"{path}/{partition}={name}" for name in names]
