"""Analytics over the log of pipeline runs and tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions import epoch_seconds, hour_bucket, micros, percent, ratio, round_to, threshold_status
from tidemart.functions.status import FAILED_RUNS_STEPS
from tidemart.functions.times import Instant
from tidemart.operators.filters import (
    is_not_null,
    since_interval,
    state_equals,
    state_in,
    time_range,
)

DAYS = 7
SHOWN = 20


def _recent(runs: DataFrame, as_of: Instant, days: int) -> DataFrame:
    return since_interval(runs, "execution_date", as_of, f"{days} days")


def runs_total(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    return _recent(runs, as_of, days).agg(F.count(F.lit(1)).alias("total_runs"))


def runs_success(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    done = state_equals(_recent(runs, as_of, days), "success")
    return done.agg(F.count(F.lit(1)).alias("successful"))


def runs_failed(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    broken = state_equals(_recent(runs, as_of, days), "failed")
    return broken.agg(F.count(F.lit(1)).alias("failed"))


def runs_failed_status(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    """The number of failed runs with the colour of its panel."""
    return runs_failed(runs, as_of, days).withColumn(
        "status", threshold_status(F.col("failed"), FAILED_RUNS_STEPS))


def runs_success_rate(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    """Successes among finished runs in percent; NULL when none has finished."""
    finished = state_in(_recent(runs, as_of, days), "success", "failed")
    good = F.count_if(F.col("state") == "success")
    return finished.agg(percent(good, F.count(F.lit(1)), 1).alias("success_rate"))


def runs_avg_duration(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    """Mean seconds of successful runs that have ended; whole microseconds are summed."""
    ended = is_not_null(state_equals(_recent(runs, as_of, days), "success"), "end_date")
    spent = micros(F.col("end_date")) - micros(F.col("start_date"))
    mean = ratio(F.sum(spent), F.count(spent) * 1e6)
    return ended.agg(round_to(mean, 1).alias("avg_duration"))


def runs_active_pipelines(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    return _recent(runs, as_of, days).agg(F.count_distinct("dag_id").alias("active_dags"))


def runs_per_hour(runs: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """Successful, failed and running runs per hour, in time order."""
    states = ("success", "failed", "running")
    return (
        time_range(runs, "execution_date", start, end)
        .groupBy(hour_bucket(runs, "execution_date").alias("time"))
        .agg(*[F.count_if(F.col("state") == state).alias(state) for state in states])
        .orderBy("time")
    )


def legend_sum(hourly: DataFrame) -> DataFrame:
    """Total of every state series over the shown range."""
    states = [name for name in hourly.columns if name != "time"]
    return hourly.agg(*[F.sum(name).alias(name) for name in states])


def run_states(runs: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    return _recent(runs, as_of, days).groupBy("state").agg(F.count(F.lit(1)).alias("count"))


def task_states(tasks: DataFrame, as_of: Instant, days: int = DAYS) -> DataFrame:
    """Task count per state, most frequent first."""
    return (
        since_interval(tasks, "start_date", as_of, f"{days} days")
        .groupBy("state")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("state"))
    )


def recent_runs(runs: DataFrame, n: int = SHOWN) -> DataFrame:
    """Latest runs; the duration of a running one is NULL."""
    seconds = epoch_seconds(F.col("end_date"), F.col("start_date"))
    latest = runs.orderBy(
        F.desc_nulls_last("execution_date"), F.asc("dag_id"), F.asc("state"),
        F.asc_nulls_last("start_date"), F.asc_nulls_last("end_date"),
    ).limit(n)
    return latest.select(
        "dag_id", "state", "execution_date", round_to(seconds, 1).alias("duration_s")
    )


def slowest_tasks(
    tasks: DataFrame, as_of: Instant, n: int = SHOWN, days: int = DAYS
) -> DataFrame:
    """Longest tasks of the last days."""
    timed = since_interval(is_not_null(tasks, "duration"), "start_date", as_of, f"{days} days")
    longest = timed.orderBy(
        F.desc("duration"), F.asc("dag_id"), F.asc("task_id"), F.asc("start_date")
    ).limit(n)
    return longest.select(
        "dag_id", "task_id", "state", round_to(F.col("duration"), 1).alias("duration_s"),
        "start_date",
    )
