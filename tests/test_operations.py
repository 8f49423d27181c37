from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import given, plan, values

from tidemart.operators import lakehouse, runs
from tidemart.operators.filters import prefix_like, since_interval, time_range
from tidemart.operators.quality import (
    DECLARED,
    dq_not_null,
    dq_relationships,
    dq_suite,
    dq_unique,
)
from tidemart.plans.models import build_models

T = dt.datetime
SNAPSHOTS = "snapshot_time timestamp"
TABLES = "table_id bigint, schema_id bigint, table_name string, end_snapshot bigint"
SCHEMAS = "schema_id bigint, schema_name string, end_snapshot bigint"
FILES = ("data_file_id bigint, table_id bigint, file_size_bytes bigint, record_count bigint, "
         "end_snapshot bigint")
RUNS = ("dag_id string, state string, execution_date timestamp, start_date timestamp, "
        "end_date timestamp")
TASKS = ("dag_id string, task_id string, state string, start_date timestamp, duration double")


def test_empty_catalog(spark):
    frames = [given(spark, ddl) for ddl in (SNAPSHOTS, TABLES, SCHEMAS, FILES)]
    summary = lakehouse.lake_summary(*frames, spark.createDataFrame([], "data_file_id bigint"),
                                     "2024-01-01 00:00:00")
    assert tuple(summary.first()) == (0, 0, 0.0, 0, 0, 0, 0, 0, 0)


def test_catalog_gauges(spark):
    snapshots = given(spark, SNAPSHOTS, {"snapshot_time": T(2024, 1, 1, 10)},
                      {"snapshot_time": T(2024, 1, 1, 11, 30)})
    tables = given(
        spark, TABLES,
        {"table_id": 1, "schema_id": 1, "table_name": "full"},
        {"table_id": 2, "schema_id": 1, "table_name": "empty"},
        {"table_id": 3, "schema_id": 1, "table_name": "dropped", "end_snapshot": 5},
        {"table_id": 4, "schema_id": 1, "table_name": "expired"},
        {"table_id": 5, "schema_id": 2, "table_name": "in dropped schema"},
    )
    schemas = given(spark, SCHEMAS, {"schema_id": 1, "schema_name": "s"},
                    {"schema_id": 2, "schema_name": "gone", "end_snapshot": 3})
    files = given(
        spark, FILES,
        {"data_file_id": 1, "table_id": 1, "file_size_bytes": 10, "record_count": 1},
        {"data_file_id": 2, "table_id": 1, "file_size_bytes": 20, "record_count": 2},
        {"data_file_id": 3, "table_id": 4, "file_size_bytes": 5, "record_count": 5,
         "end_snapshot": 9},
    )
    per_table = lakehouse.lake_per_table(tables, schemas, files)
    assert values(per_table) == [
        ("s", "empty", 0, 0, 0), ("s", "expired", 0, 0, 0), ("s", "full", 2, 30, 3)
    ]
    summary = lakehouse.lake_summary(snapshots, tables, schemas, files,
                                     files.where("end_snapshot is not null"),
                                     "2024-01-01 12:30:00")
    assert tuple(summary.first()) == (2, 1, 3600.0, 4, 1, 2, 30, 3, 1)
    long = lakehouse.gauges_to_long(summary, per_table, "2024-01-01 12:30:00")
    assert long.count() == 9 + 3 * 3
    full = long.where("metric = 'lake_table_records' and labels['table'] = 'full'").first()
    assert (full.value, full.labels) == (3.0, {"schema": "s", "table": "full"})
    assert long.where("metric = 'lake_snapshots'").first().labels == {}
    renamed = lakehouse.gauges_to_long(summary, per_table, "2024-01-01 12:30:00", prefix="house")
    assert {r.metric.replace("house_", "lake_") for r in renamed.collect()} == {r.metric for r in long.collect()}
    assert renamed.where("metric not like 'house\\_%'").count() == 0


def run(state, day, hour=0, seconds=None):
    start = T(2024, 1, day, hour)
    end = None if seconds is None else start + dt.timedelta(seconds=seconds)
    return {"dag_id": "d", "state": state, "execution_date": start, "start_date": start,
            "end_date": end}


def test_unfinished_runs_have_no_rate(spark):
    log = given(spark, RUNS, run("running", 9))
    assert runs.runs_success_rate(log, "2024-01-10 00:00:00").first()[0] is None
    assert runs.runs_avg_duration(log, "2024-01-10 00:00:00").first()[0] is None
    assert runs.recent_runs(log).first().duration_s is None


def test_run_numbers(spark):
    as_of = "2024-01-10 00:00:00"
    log = given(spark, RUNS, run("success", 3, 0, 10), run("success", 9, 1, 20.26),
                run("failed", 9, 1, 5), run("running", 9, 2), run("success", 2, 23, 1000))
    # The run exactly seven days before still counts, the one an hour earlier does not.
    assert runs.runs_total(log, as_of).first()[0] == 4
    assert runs.runs_success(log, as_of).first()[0] == 2
    assert runs.runs_failed(log, as_of).first()[0] == 1
    assert runs.runs_success_rate(log, as_of).first()[0] == 66.7
    assert runs.runs_avg_duration(log, as_of).first()[0] == 15.1
    assert runs.runs_active_pipelines(log, as_of).first()[0] == 1
    hourly = runs.runs_per_hour(log, "2024-01-09 00:00:00", "2024-01-09 23:00:00")
    assert [tuple(r) for r in hourly.collect()] == [
        (T(2024, 1, 9, 1), 1, 1, 0), (T(2024, 1, 9, 2), 0, 0, 1)
    ]
    assert tuple(runs.legend_sum(hourly).first()) == (1, 1, 1)
    assert values(runs.run_states(log, as_of)) == [("failed", 1), ("running", 1), ("success", 2)]
    assert runs.recent_runs(log, 1).first().state == "running"


def test_tasks(spark):
    as_of = "2024-01-10 00:00:00"
    rows = [("a", 1.0, 9), ("b", 9.96, 9), ("c", None, 9), ("d", 99.0, 1)]
    log = given(spark, TASKS, *[
        {"dag_id": "d", "task_id": t, "state": "success" if t < "c" else "queued",
         "start_date": T(2024, 1, day), "duration": duration} for t, duration, day in rows
    ])
    slowest = runs.slowest_tasks(log, as_of).collect()
    assert [(r.task_id, r.duration_s) for r in slowest] == [("b", 10.0), ("a", 1.0)]
    assert [tuple(r) for r in runs.task_states(log, as_of).collect()] == [
        ("success", 2), ("queued", 1)
    ]


def test_filters_reach_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    recent = since_interval(events, "ts", "2024-01-30 00:00:00", "7 days")
    assert "GreaterThanOrEqual(ts,2024-01-23T00:00)" in plan(recent)
    shown = time_range(events, "ts", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert "LessThanOrEqual(ts,2024-01-03T00:00)" in plan(shown)
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    assert "StringStartsWith(c_mktsegment,MA)" in plan(prefix_like(customers, "c_mktsegment",
                                                                   "MA"))


def test_quality_counts(spark):
    child = spark.createDataFrame([(1, 1), (1, 9), (None, 9), (2, None)], "id int, parent int")
    parent = spark.createDataFrame([(1,), (2,)], "pid int")
    assert values(dq_not_null(child, "id", "parent")) == [("id", 1), ("parent", 1)]
    assert values(dq_unique(child, "id")) == [(1, 2)]
    assert dq_relationships(child, "parent", parent, "pid").first()[0] == 2
    assert dq_relationships(child, "id", parent, "pid").first()[0] == 0


def test_suite_declares_all_tests_and_finds_failures(spark, sf):
    kinds = [len(t.not_null) for t in DECLARED.values()]
    assert (sum(kinds), sum(t.unique is not None for t in DECLARED.values()),
            sum(len(t.relationships) for t in DECLARED.values())) == (10, 4, 1)
    models = dict(build_models(spark, sf))
    orders = models["stg_orders"]
    broken = orders.where("order_id < 3").withColumns(
        {"customer_id": F.lit(-1).cast("bigint"), "order_amount": F.lit(None).cast("double")}
    )
    models["stg_orders"] = orders.unionByName(broken)
    failed = dq_suite(models).where(~F.col("passed"))
    assert values(failed, "model", "column", "test", "failures") == [
        ("stg_orders", "customer_id", "relationships", 3),
        ("stg_orders", "order_amount", "not_null", 3),
        ("stg_orders", "order_id", "unique", 3),
    ]


def test_suite_runs_without_cross_joins(spark, sf):
    text = plan(dq_suite(build_models(spark, sf)))
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("word", ["BatchEvalPython", "ArrowEvalPython", "MapInPandas"])
def test_no_python_workers(spark, sf, word):
    from tidemart.plans.registry import load_entries

    for key in ("counter_rate", "revenue_by_segment", "merge_upsert", "gauges_to_long"):
        assert word not in plan(load_entries()[key].run(spark, sf))
