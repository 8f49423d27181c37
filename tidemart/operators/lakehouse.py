"""Gauges over the catalog tables of a lakehouse."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import epoch_seconds
from tidemart.functions.times import Instant, instant, instant_like
from tidemart.operators.filters import live_rows, since_interval

PREFIX = "lake"

# Summary column -> gauge name, and the same for the per-table gauges; ``gauge_name`` changes the prefix.
SUMMARY_GAUGES = {
    "snapshots": "lake_snapshots",
    "snapshots_per_hour": "lake_snapshots_per_hour",
    "snapshot_age": "lake_snapshot_age_seconds",
    "tables": "lake_tables",
    "schemas": "lake_schemas",
    "data_files": "lake_data_files",
    "storage_bytes": "lake_storage_bytes",
    "records": "lake_records",
    "pending_deletion": "lake_files_pending_deletion",
}
TABLE_GAUGES = {
    "total_records": "lake_table_records",
    "total_bytes": "lake_table_storage_bytes",
    "file_count": "lake_table_data_files",
}


def gauge_name(name: str, prefix: str) -> str:
    """The name of a gauge under another prefix than the library's own."""
    return f"{prefix}{name.removeprefix(PREFIX)}"


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def _age(snapshots: DataFrame, as_of: Instant) -> Column:
    now = instant_like(snapshots, "snapshot_time", as_of)
    return F.coalesce(epoch_seconds(now, F.max("snapshot_time")), F.lit(0.0))


def lake_snapshot_count(snapshots: DataFrame) -> DataFrame:
    return _count(snapshots, "snapshots")


def lake_snapshots_per_hour(snapshots: DataFrame, as_of: Instant) -> DataFrame:
    return _count(
        since_interval(snapshots, "snapshot_time", as_of, "1 hour"), "snapshots_per_hour"
    )


def lake_snapshot_age(snapshots: DataFrame, as_of: Instant) -> DataFrame:
    """Seconds since the latest snapshot, 0 when there is none."""
    return snapshots.agg(_age(snapshots, as_of).alias("snapshot_age"))


def lake_snapshots(snapshots: DataFrame, as_of: Instant) -> DataFrame:
    """The three snapshot gauges in one pass."""
    hour_ago = instant_like(snapshots, "snapshot_time", as_of) - F.expr("INTERVAL 1 HOUR")
    return snapshots.agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count_if(F.col("snapshot_time") >= hour_ago).alias("snapshots_per_hour"),
        _age(snapshots, as_of).alias("snapshot_age"),
    )


def lake_live_tables(tables: DataFrame) -> DataFrame:
    return _count(live_rows(tables), "tables")


def lake_live_schemas(schemas: DataFrame) -> DataFrame:
    return _count(live_rows(schemas), "schemas")


def lake_file_totals(files: DataFrame) -> DataFrame:
    """Live files, their bytes and their records."""
    return live_rows(files).agg(
        F.count(F.lit(1)).alias("data_files"),
        F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("storage_bytes"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"),
    )


def lake_pending_deletion(scheduled: DataFrame) -> DataFrame:
    return _count(scheduled, "pending_deletion")


def lake_summary(
    snapshots: DataFrame,
    tables: DataFrame,
    schemas: DataFrame,
    files: DataFrame,
    scheduled: DataFrame,
    as_of: Instant,
) -> DataFrame:
    """The nine global gauges as one row, each table read once, all in one job.

    Each part has one row with its own columns; they are stacked and folded
    with ``max``, which needs no join.
    """
    parts = [
        lake_snapshots(snapshots, as_of),
        lake_live_tables(tables),
        lake_live_schemas(schemas),
        lake_file_totals(files),
        lake_pending_deletion(scheduled),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(name).alias(name) for name in SUMMARY_GAUGES])


def join_catalog_3way(tables: DataFrame, schemas: DataFrame, files: DataFrame) -> DataFrame:
    """Live tables of live schemas with the totals of their live files.

    Liveness of a file is tested before the outer join, so a table without
    live files stays. Files are reduced per table before they are joined.
    """
    per_table = (
        live_rows(files)
        .groupBy("table_id")
        .agg(
            F.count("data_file_id").alias("files"),
            F.sum("file_size_bytes").alias("bytes"),
            F.sum("record_count").alias("records"),
        )
    )
    names = live_rows(schemas).select("schema_id", "schema_name")
    return (
        live_rows(tables)
        .select("table_id", "schema_id", "table_name")
        .join(names, "schema_id", "inner")
        .join(per_table, "table_id", "left")
    )


def lake_per_table(tables: DataFrame, schemas: DataFrame, files: DataFrame) -> DataFrame:
    """Files, bytes and records per schema and table name; 0 for an empty table."""

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    return (
        join_catalog_3way(tables, schemas, files)
        .groupBy("schema_name", "table_name")
        .agg(
            total("files").alias("file_count"),
            total("bytes").alias("total_bytes"),
            total("records").alias("total_records"),
        )
    )


def _long(df: DataFrame, gauges: dict[str, str], labels: Sequence[tuple[str, str]]) -> DataFrame:
    pairs = [item for label, column in labels for item in (F.lit(label), F.col(column))]
    label_map = F.create_map(*pairs).cast("map<string,string>")
    readings = F.array(
        *[
            F.struct(F.lit(metric).alias("metric"), F.col(name).cast("double").alias("value"))
            for name, metric in gauges.items()
        ]
    )
    return df.select(F.explode(readings).alias("r"), label_map.alias("labels")).select(
        "r.metric", "labels", "r.value"
    )


def gauges_to_long(
    summary: DataFrame, per_table: DataFrame, as_of: Instant, prefix: str = PREFIX
) -> DataFrame:
    """All gauges as (metric, labels, ts, value) rows, ready to append to the samples."""
    table_labels = (("schema", "schema_name"), ("table", "table_name"))
    named = [{column: gauge_name(name, prefix) for column, name in gauges.items()}
             for gauges in (SUMMARY_GAUGES, TABLE_GAUGES)]
    rows = _long(summary, named[0], ()).unionByName(_long(per_table, named[1], table_labels))
    return rows.select("metric", "labels", instant(as_of).alias("ts"), "value")
