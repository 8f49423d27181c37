"""Windowed aggregations and the upsert for a continuous source."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from hashlib import sha1

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemart.operators.metrics import series_id
from tidemart.schemas import FACT_KEYS
from tidemart.session import delete_folder, restage, shared_folder
from tidemart.sources.facts import create_fact, read_dates, write_fact

# Keeps state on disk, so that it may outgrow the heap of an executor.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Session for a stream whose state is kept in ``partitions`` parts.

    The number is fixed for the life of a stream and every part writes files in
    every batch, so it follows the cores of the cluster and not the (batch)
    setting for shuffles.
    """
    session = spark.newSession()
    count = partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(count))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session


def _event_time(stream: DataFrame, name: str, delay: str) -> DataFrame:
    """Watermark on a column, which Spark wants as TIMESTAMP."""
    return stream.withColumn(name, F.col(name).cast("timestamp")).withWatermark(name, delay)


def stream_runs_per_hour(runs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Runs per hour and state; an hour is emitted once the watermark has passed it."""
    states = ("success", "failed", "running")
    return (
        _event_time(runs, "execution_date", delay)
        .groupBy(F.window("execution_date", "1 hour").alias("hour"))
        .agg(*[F.count_if(F.col("state") == state).alias(state) for state in states])
        .select(F.col("hour.start").alias("time"), *states)
    )


def stream_metric_windows(
    samples: DataFrame,
    delay: str = "2 minutes",
    width: str = "2 minutes",
    slide: str = "30 seconds",
) -> DataFrame:
    """Sum, maximum and last value of each series in sliding windows."""
    return (
        _event_time(samples, "ts", delay)
        .groupBy(
            F.window("ts", width, slide).alias("w"), "metric", series_id().alias("series")
        )
        .agg(
            F.sum("value").alias("sum"),
            F.max("value").alias("max"),
            F.max_by("value", "ts").alias("last"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "metric", "series", "sum", "max", "last",
        )
    )


def to_grain(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Reduce platform records (ts, artist_id, track_id, source, streams, revenue) to the fact.

    A watermark drops late rows only inside a stateful operator, so the daily
    aggregation is what enforces the delay. In update mode every emitted row is
    the full new value of its key.
    """
    return (
        _event_time(stream, "ts", delay)
        .groupBy(F.window("ts", "1 day").alias("day"), "artist_id", "track_id", "source")
        .agg(
            F.sum("streams").alias("streams"),
            F.sum("revenue").cast("decimal(38,9)").alias("revenue"),
            F.max("ts").alias("updated_at"),
        )
        .select(
            F.to_date("day.start").alias("event_date"),
            "artist_id", "track_id", "streams", "revenue", "source", "updated_at",
        )
    )


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality in which NULL equals NULL, so that a replay replaces its own rows."""
    return reduce(Column.__and__, [left[key].eqNullSafe(right[key]) for key in keys])


COMMITS = "batch_id bigint, state string"


def _last_commit(session: SparkSession, folder: str) -> tuple[int, str]:
    """The last batch on record and how far it has come; none on record counts as done before the first."""
    try:
        rows = session.read.schema(COMMITS).parquet(folder).collect()
    except AnalysisException:
        rows = []
    return max(((row.batch_id, row.state) for row in rows), default=(-1, "done"))


def _record(session: SparkSession, folder: str, batch_id: int, state: str) -> None:
    row = session.createDataFrame([(batch_id, state)], COMMITS)
    row.coalesce(1).write.mode("overwrite").parquet(folder)


def upsert_batch(
    session: SparkSession, path: str, keys: Sequence[str] = FACT_KEYS, stream: str = "stream"
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that replaces rows of the fact by key.

    Only dates that occur in the batch are read and rewritten. The batch and the
    merged rows are staged in the shared folder and the merge runs in
    ``session``: dates can be much larger than a batch, and the streaming session
    has neither adaptive execution nor a partition count that would suit them.

    A record beside the table, one for each ``stream`` (a name that stays the
    same when the stream starts again), says how far the last batch has come. A
    batch that is done is skipped when it is replayed. One that was merged but maybe not
    written is written again from its staged rows, since dates that the
    write had already replaced or removed can't be merged again. Staged rows of
    a batch are deleted once it is done.
    """
    record = f"{path}/_commits/{stream}"
    staging = f"{shared_folder(session)}/upsert-{sha1(record.encode()).hexdigest()}"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        last, state = _last_commit(session, record)
        if batch_id < last or (batch_id == last and state == "done"):
            return
        if batch_id == last:
            merged = session.read.schema(batch.schema).parquet(f"{staging}/merged")
        else:
            incoming = restage(batch, f"{staging}/incoming", session)
            days = [row.event_date for row in incoming.select("event_date").distinct().collect()]
            touched = read_dates(session, path, F.col("day").isin([day for day in days if day is not None]),
                                 none=None in days)
            kept = touched.join(incoming, _same_key(touched, incoming, keys), "left_anti")
            merged = restage(kept.select(incoming.columns).unionByName(incoming), f"{staging}/merged", session)
            _record(session, record, batch_id, "merged")
        write_fact(merged, path, only_touched=True)
        _record(session, record, batch_id, "done")
        delete_folder(session, staging)

    return upsert


def stream_upsert(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "7 days",
    session: SparkSession | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep the fact table at ``path`` up to date; rows later than ``delay`` are dropped.

    ``session`` runs the merges, by default the one that made the stream. The
    record of finished batches belongs to ``checkpoint``, whose batches it counts.
    """
    session = session or stream.sparkSession
    create_fact(session, path)
    return (
        to_grain(stream, delay)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .foreachBatch(upsert_batch(session, path, stream=sha1(checkpoint.rstrip("/").encode()).hexdigest()))
        .start()
    )


def stream_to_table(
    df: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append finished windows to a Parquet table."""
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
