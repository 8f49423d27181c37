"""Date-partitioned, clustered tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.functions.times import instant_like
from tidemart.schemas import DASHBOARD_CLUSTER, FACT_CLUSTER, FACT_DDL
from tidemart.sources import partition_index
from tidemart.sources.partition_index import Dates

Day = str | dt.date


def write_fact(
    df: DataFrame,
    path: str,
    partition: str = "event_date",
    cluster: Sequence[str] = FACT_CLUSTER,
    mode: str = "overwrite",
    only_touched: bool = False,
) -> Dates:
    """Write one folder per ``partition`` value, rows sorted by the cluster columns.

    Rows are range-partitioned on the date and the cluster columns together. A
    date that holds a large share of the rows is therefore spread over many
    tasks, while each file keeps a narrow range of the cluster columns, so a
    reader can skip files and row groups by their min/max statistics.
    ``only_touched`` replaces just the partitions that occur in ``df``. The
    dates are noted while they are written and added to the table's index;
    returns the dates of ``df``.
    """
    spark, keys = df.sparkSession, [partition, *cluster]
    anew = mode == "overwrite" and not only_touched
    known = Dates() if anew else partition_index.read(spark, path)
    partition_index.mark(spark, path)
    # The dates are noted after the shuffle: what stands before it is read twice, to find the ranges.
    dealt, seen = partition_index.observed(df.repartitionByRange(*keys), partition)
    writer = dealt.sortWithinPartitions(*keys).write.mode(mode).partitionBy(partition)
    if only_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    written = partition_index.dates_of(seen, df, partition)
    if known is None:
        known = partition_index.listed(spark, path, partition, df.schema)
    partition_index.replace(spark, path, known | written)
    return written


def write_dashboard(df: DataFrame, path: str) -> None:
    """Replace the dashboard mart, clustered by artist and source."""
    write_fact(df, path, cluster=DASHBOARD_CLUSTER)


def create_fact(spark: SparkSession, path: str) -> None:
    """An empty fact table, unless there is one already."""
    empty = spark.createDataFrame([], FACT_DDL)
    try:
        empty.write.mode("errorifexists").partitionBy("event_date").parquet(path)
    except AnalysisException as found:
        if found.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        partition_index.replace(spark, path, Dates())


def _open(spark: SparkSession, schema: str | StructType | None, path: str, *folders: str) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("basePath", path).parquet(*(folders or [path]))


def read_all(spark: SparkSession, path: str, schema: str | StructType | None = FACT_DDL) -> DataFrame:
    """The whole fact, all dates and rows without a date; for checks and exports."""
    return _open(spark, schema, path)


def read_dates(
    spark: SparkSession,
    path: str,
    wanted: Column,
    partition: str = "event_date",
    schema: str | StructType | None = FACT_DDL,
    none: bool = False,
) -> DataFrame:
    """The rows of the dates that a condition on ``day`` selects; only their folders are listed.

    ``none`` adds the rows without a date. Without a trusted index the whole
    table is listed and its partitions pruned.
    """
    dates = partition_index.read(spark, path, wanted)
    if dates is None:
        selected = (wanted | F.col("day").isNull()) if none else wanted
        return _open(spark, schema, path).withColumn("day", F.col(partition)).where(selected).drop("day")
    folders = partition_index.folders(path, partition, Dates(dates.days, none and dates.none))
    if folders:
        return _open(spark, schema, path, *folders)
    # No folder to read; only a given schema tells the columns without a look at the table.
    return spark.createDataFrame([], schema) if schema else _open(spark, schema, path).limit(0)


def read_fact(
    spark: SparkSession,
    path: str,
    start: Day,
    end: Day,
    partition: str = "event_date",
    schema: str | StructType | None = FACT_DDL,
) -> DataFrame:
    """Read a range of partitions, both ends included; the range is mandatory."""
    if start is None or end is None:
        raise ValueError(f"a range on the partition column {partition} is required")
    low, high = (F.lit(str(day)).cast("date") for day in (start, end))
    return read_dates(spark, path, F.col("day").between(low, high), partition, schema)


def fact_view(spark: SparkSession, path: str, name: str, start: Day, end: Day) -> DataFrame:
    """Name a range of the fact for SQL users; only the folders of the range are listed."""
    read_fact(spark, path, start, end).createOrReplaceTempView(name)
    return spark.table(name)


def _known(spark: SparkSession, path: str, partition: str, schema: StructType) -> Dates:
    """The dates of a table that may not exist yet."""
    found = partition_index.read(spark, path)
    try:
        return partition_index.listed(spark, path, partition, schema) if found is None else found
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return Dates()


def append_new(
    df: DataFrame,
    path: str,
    since: Day | None = None,
    partition: str = "event_date",
    cluster: Sequence[str] = FACT_CLUSTER,
    match: Sequence[str] | None = None,
    lookback_days: int = 0,
) -> Dates:
    """Append the rows of an immutable source that the table does not have yet.

    The mark is the table's last date. Rows of later dates are new. Rows of the mark's
    date, of ``lookback_days`` before it and without a date are matched against
    those of the table: whole rows and their number, so that a source may hold
    equal ones, or the columns in ``match`` if others change between loads. A
    second call with the same source appends nothing, and rows that
    reach a date later are found. ``since`` leaves out rows up to that date.
    """
    spark, schema = df.sparkSession, df.schema
    day = F.col(partition)
    if since is not None:
        df = df.where(day.isNull() | (day > instant_like(df, partition, since)))
    known = _known(spark, path, partition, schema)
    if not known.days and not known.none:
        return write_fact(df, path, partition, cluster, mode="append")
    mark = max(known.days, default=dt.date.min)
    first = mark - dt.timedelta(days=min(lookback_days, (mark - dt.date.min).days))
    low, last = (F.lit(str(bound)).cast("date") for bound in (first, mark))
    there = read_dates(spark, path, F.col("day").between(low, last), partition, schema, none=True).select(df.columns)
    near = df.where(day.isNull() | day.between(low, last))
    if match is None:
        late = near.exceptAll(there)
    else:
        keys = there.select(*[F.col(name).alias(f"_{name}") for name in match]).distinct()
        same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in match])
        late = near.join(keys, same, "left_anti")
    return write_fact(df.where(day > last).unionByName(late), path, partition, cluster, mode="append")
