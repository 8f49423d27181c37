"""Several platform sources merged into one fact, and the dashboard built on it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions.times import Instant
from tidemart.operators.filters import between_dates_and_key, rolling_reprocess_window
from tidemart.schemas import FACT_DDL, FACT_KEYS, FACT_MEASURES, check_contract
from tidemart.session import fresh_path, restage
from tidemart.sources.facts import create_fact, read_dates, write_fact


def union_all_sources(*sources: DataFrame) -> DataFrame:
    """UNION ALL of canonical projections; every input is checked first."""
    return reduce(
        DataFrame.unionByName, [check_contract(source, FACT_DDL) for source in sources]
    )


def _complete(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])


def _spread_keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_salt``: 0 for a complete key, else a hash of the row.

    Rows with a NULL in the key match nothing, wherever they are sent. The salt
    keeps a large number of them from meeting in one task.
    """
    salt = F.when(_complete(keys), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*df.columns))
    return df.withColumn("_salt", salt)


def _unique_or_fail(source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mark the source rows, and stop the job when a complete key occurs twice.

    The count runs over the same partitioning and order that the join below
    needs, so the check adds no shuffle and no sort to the merge.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_salt"))
    text = F.concat(
        F.lit("merge source has more than one row for "), F.to_json(F.struct(*keys))
    )
    is_source = F.when(
        (F.col("_copies") > 1) & _complete(keys), F.raise_error(text).cast("boolean")
    ).otherwise(F.lit(True))
    return source.withColumn("_copies", copies).select(
        *keys, "_salt", *columns, is_source.alias("_is_source")
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = FACT_KEYS,
    update_cols: Sequence[str] = FACT_MEASURES,
) -> DataFrame:
    """The target after the merge: matched rows updated, new rows inserted.

    A matched row takes all update columns of the source, also its NULLs. No
    target row is deleted. A NULL in the key matches nothing, so such rows of
    either side are kept as they are. Complete keys are unique on both sides
    (the source is checked), so no join key is hot. Each side is read once.
    """
    old = _spread_keyless(target, keys).select(
        *keys, "_salt", *[F.col(name).alias(f"_old_{name}") for name in update_cols]
    )
    new = _unique_or_fail(_spread_keyless(source, keys), keys, update_cols)
    merged = old.join(new, [*keys, "_salt"], "full").select(
        *keys,
        *[
            F.when(F.col("_is_source"), F.col(name)).otherwise(F.col(f"_old_{name}")).alias(name)
            for name in update_cols
        ],
    )
    return merged.select(*target.columns)


def incremental_merge(
    target: DataFrame, sources: Sequence[DataFrame], run_date: Instant, days: int = 7
) -> DataFrame:
    """The window of the fact after one daily run.

    Only source rows of the last ``days`` days take part and only the target
    dates of the same window can match them; older dates are not read.
    """
    recent = [rolling_reprocess_window(source, run_date, days) for source in sources]
    return merge_upsert(
        rolling_reprocess_window(target, run_date, days), union_all_sources(*recent)
    )


def apply_incremental_merge(
    spark: SparkSession,
    path: str,
    sources: Sequence[DataFrame],
    run_date: Instant,
    days: int = 7,
) -> None:
    """Merge the window into the partitioned table at ``path``, made if absent.

    Partitions outside the window keep their files. The merged rows are
    staged first, because a job cannot overwrite the files it reads. A rerun of
    the same day gives the same table, but for source rows with a NULL in the
    key: those match nothing and are inserted again.
    """
    create_fact(spark, path)
    # Any later date too: the window has no end.
    target = read_dates(spark, path, F.col("day") >= F.date_sub(F.lit(str(run_date)).cast("date"), days))
    merged = restage(
        incremental_merge(target, sources, run_date, days), fresh_path(spark, "merged"), spark
    )
    write_fact(merged, path, only_touched=True)


def dashboard_artist_daily(fact: DataFrame) -> DataFrame:
    """Sums and exact distinct tracks per date, artist and source.

    Spark first reduces by group and track, so a dominant artist is spread
    over its tracks before the final, small aggregation.
    """
    return fact.groupBy("event_date", "artist_id", "source").agg(
        F.sum("streams").alias("streams"),
        F.sum("revenue").cast("decimal(38,9)").alias("revenue"),
        F.count_distinct("track_id").alias("tracks"),
    )


def query_dashboard(mart: DataFrame, start: Instant, end: Instant, artist_id: str) -> DataFrame:
    """One artist's days in a range; reads only the folders of that range."""
    return between_dates_and_key(mart, start, end, artist_id).select(
        "event_date", "source", "streams", "revenue"
    )
