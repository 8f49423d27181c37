"""Operational inputs projected from the raw tables.

The test tables hold no run log, catalog, metric samples or platform feeds.
Each is derived here from a whole table, and in the same way in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import micros
from tidemart.functions.status import choose
from tidemart.operators.lakehouse import SUMMARY_GAUGES, TABLE_GAUGES
from tidemart.operators.metrics import CPU, DISK, MEMORY, MEMORY_LIMIT, NETWORK
from tidemart.operators.staging import SOURCE_A, SOURCE_B, stg_platform
from tidemart.operators.unified import union_all_sources
from tidemart.sources.tables import scan_source

# Fixed instants in place of the current time.
AS_OF = "2024-01-30 12:00:00"
RANGE = ("2024-01-05 00:00:00", "2024-01-20 23:59:59")
RUN_DATE = "2024-01-28"
FIRST_LOAD_UNTIL = "2024-01-24 12:00:00"

LAKE_GAUGES = [*SUMMARY_GAUGES.values(), *TABLE_GAUGES.values()]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_source(spark, sf_dir, "events")


def _state():
    kind = F.col("event_type")
    return (
        F.when(kind.isin("purchase", "click"), "success")
        .when(kind == "error", "failed")
        .when(kind == "view", "running")
        .otherwise("queued")
    )


def _dag_id():
    return F.concat(F.lit("dag_"), (F.col("user_id") % 10).cast("string"))


def run_log(log: DataFrame) -> DataFrame:
    """Runs (dag_id, state, execution_date, start_date, end_date); open ones have no end."""
    end = F.timestamp_micros(micros(F.col("ts")) + F.rint(F.col("value") * 1e6).cast("bigint"))
    return log.select(
        _dag_id().alias("dag_id"),
        _state().alias("state"),
        F.col("ts").alias("execution_date"),
        F.col("ts").alias("start_date"),
        F.when(_state().isin("success", "failed"), end).cast("timestamp_ntz").alias("end_date"),
    )


def task_log(log: DataFrame) -> DataFrame:
    """Tasks (dag_id, task_id, state, start_date, duration)."""
    return log.select(
        _dag_id().alias("dag_id"),
        F.col("event_type").alias("task_id"),
        _state().alias("state"),
        F.col("ts").alias("start_date"),
        F.when(_state().isin("success", "failed"), F.col("value")).alias("duration"),
    )


def _track():
    return F.get_json_object("props", "$.k").cast("bigint")


def platform_a(log: DataFrame) -> DataFrame:
    """Daily streams per artist and track, without revenue: the views."""
    return (
        log.where(F.col("event_type") == "view")
        .groupBy(
            F.to_date("ts").cast("timestamp").alias("stream_date"),
            F.col("user_id").alias("artist_id"),
            _track().alias("track_id"),
        )
        .agg(F.count(F.lit(1)).alias("streams"), F.max("ts").alias("updated_at"))
    )


def platform_b(log: DataFrame) -> DataFrame:
    """Daily views with revenue as text, some of it unusable: the purchases."""
    purchases = log.where(F.col("event_type") == "purchase").select(
        F.to_date("ts").cast("timestamp").alias("report_date"),
        F.col("user_id").alias("channel_artist_id"),
        _track().alias("video_track_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        "ts",
    )
    amount = F.sum("amount").cast("decimal(28,2)").cast("string")
    return purchases.groupBy("report_date", "channel_artist_id", "video_track_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.when(F.col("video_track_id") % 10 == 0, "n/a").otherwise(amount)
        .alias("estimated_revenue"),
        F.max("ts").alias("updated_at"),
    )


def staged_sources(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        stg_platform(platform_a(log), SOURCE_A, "source_a"),
        stg_platform(platform_b(log), SOURCE_B, "source_b"),
    )


def fact(log: DataFrame) -> DataFrame:
    return union_all_sources(*staged_sources(log))


def first_load(log: DataFrame) -> DataFrame:
    """The fact as an earlier run left it: the records up to the middle of a day.

    Its streams are too high, so that rows updated and rows kept by a merge can
    be told apart from each other and from the sources.
    """
    old = fact(log.where(F.col("ts") < F.lit(FIRST_LOAD_UNTIL).cast("timestamp_ntz")))
    return old.withColumn("streams", F.col("streams") + 1000)


def platform_records(log: DataFrame) -> DataFrame:
    """Single platform records, as a continuous source delivers them."""
    kind = F.col("event_type")
    paid = F.when(kind == "purchase", F.col("value").cast("decimal(18,2)"))
    return log.where(kind.isin("view", "purchase")).select(
        "ts",
        F.col("user_id").cast("string").alias("artist_id"),
        _track().cast("string").alias("track_id"),
        F.when(kind == "view", "source_a").otherwise("source_b").alias("source"),
        F.lit(1).cast("bigint").alias("streams"),
        paid.alias("revenue"),
    )


def lake_catalog(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Catalog tables: orders as files, customers as tables, nations as schemas."""
    orders = scan_source(spark, sf_dir, "orders")
    ended = F.lit(1).cast("bigint")
    partial = F.col("o_orderstatus") == "P"
    return {
        "snapshots": orders.select(F.col("o_orderdate").alias("snapshot_time")).distinct(),
        "tables": scan_source(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("table_id"),
            F.col("c_nationkey").cast("bigint").alias("schema_id"),
            F.col("c_name").alias("table_name"),
            F.when(F.col("c_mktsegment") == "MACHINERY", ended).alias("end_snapshot"),
        ),
        "schemas": scan_source(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("bigint").alias("schema_id"),
            F.col("n_name").alias("schema_name"),
            F.when(F.col("n_regionkey") == 4, ended).alias("end_snapshot"),
        ),
        "files": orders.select(
            F.col("o_orderkey").alias("data_file_id"),
            F.col("o_custkey").alias("table_id"),
            F.floor("o_totalprice").alias("file_size_bytes"),
            F.floor(F.col("o_totalprice") / 100).alias("record_count"),
            F.when(partial, ended).alias("end_snapshot"),
        ),
        "scheduled": orders.where(partial).select(F.col("o_orderkey").alias("data_file_id")),
    }


def _name():
    bucket = F.col("user_id") % 20
    return F.when(bucket == 0, "").otherwise(F.concat(F.lit("c"), bucket.cast("string")))


def container_samples(log: DataFrame) -> DataFrame:
    """Counters with many resets; series of some users have an empty name."""
    metric = choose(
        F.col("event_type"),
        {
            "click": F.lit(CPU),
            "signup": F.lit(NETWORK["rx"]),
            "error": F.lit(NETWORK["tx"]),
            "purchase": F.lit(DISK["read"]),
            "view": F.lit(DISK["write"]),
        },
    )
    labels = F.create_map(
        F.lit("name"), _name(), F.lit("instance"), F.col("user_id").cast("string")
    )
    return log.select(metric.alias("metric"), labels.alias("labels"), "ts", "value")


def memory_samples(log: DataFrame) -> DataFrame:
    """Hourly memory and memory limit per container; the limit is sometimes 0."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    limit = F.col("event_type") == "purchase"
    unset = limit & (F.hour("ts") % 7 == 0)
    return (
        log.where(F.col("event_type").isin("view", "purchase"))
        .groupBy(
            F.when(limit, MEMORY_LIMIT).otherwise(MEMORY).alias("metric"),
            _name().alias("name"), hour.alias("ts"),
        )
        .agg(F.max(F.when(unset, 0.0).otherwise(F.col("value"))).alias("value"))
        .select("metric", F.create_map(F.lit("name"), F.col("name")).alias("labels"), "ts",
                "value")
    )


def lake_samples(log: DataFrame) -> DataFrame:
    """Readings of the twelve catalog gauges over time; some readings are NULL."""
    k = F.get_json_object("props", "$.k").cast("int")
    metric = F.element_at(
        F.array(*map(F.lit, LAKE_GAUGES)), (F.col("user_id") % len(LAKE_GAUGES) + 1).cast("int")
    )
    labels = F.create_map(
        F.lit("schema"), F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")),
        F.lit("table"), F.concat(F.lit("t"), (k % 5).cast("string")),
    )
    return log.select(
        metric.alias("metric"), labels.alias("labels"), "ts",
        F.when(k % 10 != 0, F.col("value")).alias("value"),
    )
