"""Raw tables, seeds, materialised models and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.session import delete_folder

RAW_TABLES = (
    "customer", "orders", "lineitem", "supplier", "nation", "region", "part", "partsupp",
)


def scan_source(spark: SparkSession, location: str, table: str) -> DataFrame:
    """A declared raw table: a Parquet file below a folder, or ``database.table``."""
    if "/" in location:
        return spark.read.parquet(f"{location.rstrip('/')}/{table}.parquet")
    return spark.table(f"{location}.{table}")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Database whose tables live below ``location``, or in the warehouse folder."""
    place = f" LOCATION '{location}/{name}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def _bucketed(df: DataFrame, column: str, count: int) -> DataFrameWriter:
    """Writer of one file per bucket.

    Rows are first sent to their bucket's task, or every task would write a
    file for every bucket. Bucket on keys that are close to unique only: a key
    with very many rows makes a bucket that one task has to read.
    """
    return df.repartition(count, column).write.bucketBy(count, column).sortBy(column)


def load_raw(
    spark: SparkSession,
    src_dir: str,
    database: str,
    tables: Iterable[str] = RAW_TABLES,
    buckets: Mapping[str, tuple[str, int]] | None = None,
    location: str | None = None,
) -> DataFrame:
    """Copy source tables into ``database``; a table that exists is left alone.

    Every table is checked by itself, so a load that stopped half-way is
    completed by the next call. A table is registered after its files are
    written; what a load that stopped has left in its folder is deleted and the table
    loaded again. ``buckets`` maps a table to (column, count):
    tables bucketed on a shared key later join and aggregate on it without a
    shuffle. Returns one row per table: name, rows and whether it was skipped.
    """
    buckets = buckets or {}
    create_database(spark, database, location)
    report = []
    for table in tables:
        name = f"{database}.{table}"
        present = spark.catalog.tableExists(name)
        if not present:
            # Files without a table: a load that stopped before it was registered.
            delete_folder(spark, f"{spark.catalog.getDatabase(database).locationUri}/{table.lower()}")
            source = scan_source(spark, src_dir, table)
            writer = _bucketed(source, *buckets[table]) if table in buckets else source.write
            writer.mode("ignore").saveAsTable(name)
        report.append((table, spark.table(name), present))
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(table).alias("table"), "rows", F.lit(present).alias("skipped")
            )
            for table, df, present in report
        ],
    )


def load_seed(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    name: str,
    location: str | None = None,
) -> DataFrame:
    """CSV with a header line into a typed table; no type inference."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # With FAILFAST a malformed value stops the load instead of becoming NULL.
    rows = spark.read.csv(path, schema=wanted, header=True, mode="FAILFAST")
    return materialize(rows, name, location)


def scan_seed(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a loaded seed."""
    return spark.table(name)


def materialize(
    df: DataFrame,
    name: str,
    location: str | None = None,
    bucket_by: tuple[str, int] | None = None,
    measure: Mapping[str, Column] | None = None,
) -> DataFrame | tuple[DataFrame, dict[str, object]]:
    """Full refresh of a saved table; views that read it stay in place.

    The new content must not read the table it replaces. ``measure`` names
    aggregates that are worked out while the rows are written, without another
    scan; they are then returned as well.
    """
    spark = df.sparkSession
    if measure:
        seen = Observation()
        df = df.observe(seen, *[value.alias(label) for label, value in measure.items()])
    if "." in name:
        create_database(spark, name.split(".")[0], location)
    writer = _bucketed(df, *bucket_by) if bucket_by else df.write
    writer.mode("overwrite").format("parquet").saveAsTable(name)
    return (spark.table(name), seen.get) if measure else spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a saved table if it exists; nothing that depends on it is dropped."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL users; it is evaluated again at each read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def register_models(models: Mapping[str, DataFrame]) -> None:
    """Make every model available to ``sql`` under its own name."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Run a user's query over the registered models."""
    return spark.sql(text)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows, in no particular order."""
    return df.limit(n)
