"""Run analytics, catalog gauges and metric panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.functions import round_to, threshold_status
from tidemart.functions.status import MEMORY_STEPS
from tidemart.operators import lakehouse, metrics
from tidemart.operators import runs as run_ops
from tidemart.operators.metrics import DISK, MEMORY, MEMORY_LIMIT, NETWORK
from tidemart.plans import inputs
from tidemart.plans.inputs import AS_OF, RANGE
from tidemart.plans.oracle import PANEL_WINDOW_S, RATE_WINDOW_S, rounded
from tidemart.plans.registry import query

_WEEK = f"execution_date >= timestamp '{AS_OF}' - interval 7 day"
_SHOWN = f"execution_date between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'"


def _runs(spark, sf):
    return inputs.run_log(inputs.events(spark, sf))


def _tasks(spark, sf):
    return inputs.task_log(inputs.events(spark, sf))


@query("runs_total", f"select count(*) as total_runs from run_log where {_WEEK}")
def _(spark, sf):
    return run_ops.runs_total(_runs(spark, sf), AS_OF)


@query("runs_success", f"select count(*) filter (where state = 'success') as successful "
       f"from run_log where {_WEEK}")
def _(spark, sf):
    return run_ops.runs_success(_runs(spark, sf), AS_OF)


@query("runs_failed", f"select count(*) filter (where state = 'failed') as failed "
       f"from run_log where {_WEEK}")
def _(spark, sf):
    return run_ops.runs_failed(_runs(spark, sf), AS_OF)


@query("runs_failed_status", f"select failed, case when failed >= 1 then 'red' else 'green' end as status "
       f"from (select count(*) filter (where state = 'failed') as failed from run_log where {_WEEK}) r")
def _(spark, sf):
    return run_ops.runs_failed_status(_runs(spark, sf), AS_OF)


_GOOD = "count(*) filter (where state = 'success')"
_DONE = "count(*) filter (where state = 'success' or state = 'failed')"


@query("runs_success_rate", f"select {rounded(f'100.0 * {_GOOD} / nullif({_DONE}, 0)', 1)} "
       f"as success_rate from run_log where {_WEEK}")
def _(spark, sf):
    return run_ops.runs_success_rate(_runs(spark, sf), AS_OF)


@query("runs_avg_duration", f"""
    select {rounded("sum(epoch_us(end_date) - epoch_us(start_date)) / (count(*) * 1000000.0)", 1)}
           as avg_duration
    from run_log where state = 'success' and end_date is not null and {_WEEK}""")
def _(spark, sf):
    return run_ops.runs_avg_duration(_runs(spark, sf), AS_OF)


@query("runs_active_pipelines", f"select count(distinct dag_id) as active_dags "
       f"from run_log where {_WEEK}")
def _(spark, sf):
    return run_ops.runs_active_pipelines(_runs(spark, sf), AS_OF)


_HOURLY = f"""
    select cast(date_trunc('hour', execution_date) as timestamp) as time,
           count(*) filter (where state = 'success') as success,
           count(*) filter (where state = 'failed') as failed,
           count(*) filter (where state = 'running') as running
    from run_log where {_SHOWN} group by 1"""


@query("runs_per_hour_by_state", f"{_HOURLY} order by 1")
def _(spark, sf):
    return run_ops.runs_per_hour(_runs(spark, sf), *RANGE)


@query("series_legend_sum", f"select cast(sum(success) as bigint) as success, "
       f"cast(sum(failed) as bigint) as failed, cast(sum(running) as bigint) as running "
       f"from ({_HOURLY}) h")
def _(spark, sf):
    return run_ops.legend_sum(run_ops.runs_per_hour(_runs(spark, sf), *RANGE))


@query("run_state_distribution", f"select state, count(*) as count from run_log "
       f"where {_WEEK} group by state")
def _(spark, sf):
    return run_ops.run_states(_runs(spark, sf), AS_OF)


@query("task_state_distribution", f"select state, count(*) as count from task_log "
       f"where start_date >= timestamp '{AS_OF}' - interval 7 day "
       f"group by state order by 2 desc, 1")
def _(spark, sf):
    return run_ops.task_states(_tasks(spark, sf), AS_OF)


@query("recent_runs", f"""
    select dag_id, state, execution_date,
           {rounded("(epoch_us(end_date) - epoch_us(start_date)) / 1000000.0", 1)} as duration_s
    from run_log order by execution_date desc, dag_id, state, start_date, end_date limit 20""")
def _(spark, sf):
    return run_ops.recent_runs(_runs(spark, sf))


@query("slowest_tasks", f"""
    select dag_id, task_id, state, {rounded("duration", 1)} as duration_s, start_date
    from task_log
    where duration is not null and start_date >= timestamp '{AS_OF}' - interval 7 day
    order by duration desc, dag_id, task_id, start_date limit 20""")
def _(spark, sf):
    return run_ops.slowest_tasks(_tasks(spark, sf), AS_OF)


def _catalog(spark, sf):
    return inputs.lake_catalog(spark, sf)


@query("lake_snapshot_count", "select snapshots from lake_totals")
def _(spark, sf):
    return lakehouse.lake_snapshot_count(_catalog(spark, sf)["snapshots"])


# The snapshots are order dates, so the last hour is taken before one of them.
_LATE = "1998-06-15 00:30:00"


@query("lake_snapshots_per_hour", f"select count(*) as snapshots_per_hour from snapshots "
       f"where snapshot_time >= timestamp '{_LATE}' - interval 1 hour")
def _(spark, sf):
    return lakehouse.lake_snapshots_per_hour(_catalog(spark, sf)["snapshots"], _LATE)


@query("lake_snapshot_age", "select snapshot_age from lake_totals")
def _(spark, sf):
    return lakehouse.lake_snapshot_age(_catalog(spark, sf)["snapshots"], AS_OF)


@query("lake_live_tables", "select tables from lake_totals")
def _(spark, sf):
    return lakehouse.lake_live_tables(_catalog(spark, sf)["tables"])


@query("lake_live_schemas", "select schemas from lake_totals")
def _(spark, sf):
    return lakehouse.lake_live_schemas(_catalog(spark, sf)["schemas"])


@query("lake_file_totals", "select data_files, storage_bytes, records from lake_totals")
def _(spark, sf):
    return lakehouse.lake_file_totals(_catalog(spark, sf)["files"])


@query("lake_pending_deletion", "select pending_deletion from lake_totals")
def _(spark, sf):
    return lakehouse.lake_pending_deletion(_catalog(spark, sf)["scheduled"])


def _summary(spark, sf):
    return lakehouse.lake_summary(**_catalog(spark, sf), as_of=AS_OF)


def _per_table(spark, sf):
    parts = _catalog(spark, sf)
    return lakehouse.lake_per_table(parts["tables"], parts["schemas"], parts["files"])


@query("lake_summary", "select * from lake_totals")
def _(spark, sf):
    return _summary(spark, sf)


@query("lake_per_table", "select * from per_table")
def _(spark, sf):
    return _per_table(spark, sf)


@query("order_by_two_keys", "select schema_name, table_name, file_count from per_table "
       "order by schema_name, table_name")
def _(spark, sf):
    return (
        _per_table(spark, sf)
        .orderBy("schema_name", "table_name")
        .select("schema_name", "table_name", "file_count")
    )


@query("join_catalog_3way", """
    select t.table_id, schema_name, table_name, nullif(count(data_file_id), 0) as files
    from (select * from lake_table_rows where end_snapshot is null) t
    join (select * from lake_schema_rows where end_snapshot is null) s using (schema_id)
    left join lake_files f on f.table_id = t.table_id and f.end_snapshot is null
    group by all""")
def _(spark, sf):
    parts = _catalog(spark, sf)
    joined = lakehouse.join_catalog_3way(parts["tables"], parts["schemas"], parts["files"])
    return joined.select("table_id", "schema_name", "table_name", "files")


_SUMMARY_LONG = " union all ".join(
    f"select '{metric}' as metric, '' as schema_label, '' as table_part, "
    f"cast({name} as double) as value from lake_totals"
    for name, metric in lakehouse.SUMMARY_GAUGES.items()
)
_TABLE_LONG = " union all ".join(
    f"select '{metric}', schema_name, table_name, cast({name} as double) from per_table"
    for name, metric in lakehouse.TABLE_GAUGES.items()
)


@query("gauges_to_long", f"select *, timestamp '{AS_OF}' as ts "
       f"from ({_SUMMARY_LONG} union all {_TABLE_LONG}) g")
def _(spark, sf):
    rows = lakehouse.gauges_to_long(_summary(spark, sf), _per_table(spark, sf), AS_OF)
    return rows.select(
        "metric",
        F.coalesce(metrics.label("schema"), F.lit("")).alias("schema_label"),
        F.coalesce(metrics.label("table"), F.lit("")).alias("table_part"),
        "value",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


def _containers(spark, sf):
    return inputs.container_samples(inputs.events(spark, sf))


def _memory(spark, sf):
    return inputs.memory_samples(inputs.events(spark, sf))


def _readings(spark, sf):
    return inputs.lake_samples(inputs.events(spark, sf))


def _six(name):
    return round_to(F.col(name), 6).alias(name)


@query("series_sum_by_name", f"select name, date_trunc('hour', ts) as ts, "
       f"{rounded('sum(value)', 6)} as value from samples group by 1, 2")
def _(spark, sf):
    samples = _containers(spark, sf)
    hourly = samples.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return metrics.sum_by(hourly, "name").select("name", "ts", _six("value"))


@query("memory_by_name", f"select name, ts, {rounded('value', 6)} as value from memory "
       f"where metric = '{MEMORY}' and name <> ''")
def _(spark, sf):
    return metrics.memory_by_name(_memory(spark, sf)).select("name", "ts", _six("value"))


@query("series_last_max", "select metric, name, instance, arg_max(value, ts) as last, "
       "max(value) as max from samples group by all")
def _(spark, sf):
    named = _containers(spark, sf).select(
        "metric", metrics.label("name").alias("name"),
        metrics.label("instance").alias("instance"), "ts", "value",
    )
    return metrics.last_max(named, "metric", "name", "instance")


@query("series_last_not_null", "select metric, arg_max(value, ts) as value "
       "from lake_readings where value is not null group by metric")
def _(spark, sf):
    return metrics.last_not_null(_readings(spark, sf), "metric")


@query("series_ratio_join", f"""
    select n.name, n.ts, n.value / d.value as value
    from memory n join memory d on n.name = d.name and n.ts = d.ts
    where n.metric = '{MEMORY}' and d.metric = '{MEMORY_LIMIT}' and d.value > 0""")
def _(spark, sf):
    return metrics.series_ratio_join(_memory(spark, sf), MEMORY, MEMORY_LIMIT)


@query("memory_pct_of_limit", f"""
    select n.name, n.ts, n.value / d.value as value
    from memory n join memory d on n.name = d.name and n.ts = d.ts
    where n.metric = '{MEMORY}' and d.metric = '{MEMORY_LIMIT}' and d.value > 0
      and n.name <> ''""")
def _(spark, sf):
    return metrics.memory_ratio(_memory(spark, sf))


@query("counter_rate", f"select metric, name, instance, ts, {rounded('rate', 6)} as rate "
       "from rates")
def counter_rate(spark, sf):
    return metrics.counter_rate(_containers(spark, sf), RATE_WINDOW_S).select(
        "metric", metrics.label("name").alias("name"),
        metrics.label("instance").alias("instance"), "ts", _six("rate"),
    )


@query("counter_rate_by_rows", f"select metric, name, instance, ts, {rounded('rate', 6)} as rate "
       "from panel_rates")
def _(spark, sf):
    # Few rows a chunk, so that the test tables have dense series too.
    return metrics.counter_rate(_containers(spark, sf), PANEL_WINDOW_S, chunk_rows=2).select(
        "metric", metrics.label("name").alias("name"),
        metrics.label("instance").alias("instance"), "ts", _six("rate"),
    )


@query("cpu_percent_by_name", "select * from cpu")
def _(spark, sf):
    return metrics.cpu_percent(_containers(spark, sf), RATE_WINDOW_S).select(
        "name", "ts", _six("value")
    )


def _directions(names, rates="rates"):
    arms = " ".join(f"when '{metric}' then '{text}'" for text, metric in names.items())
    listed = ", ".join(f"'{metric}'" for metric in names.values())
    return f"""
    select case metric {arms} end as direction, name, instance, ts, {rounded("rate", 6)} as rate
    from {rates} where metric in ({listed}) and name <> ''"""


def _io(rates):
    return rates.select(
        "direction", metrics.label("name").alias("name"),
        metrics.label("instance").alias("instance"), "ts", _six("rate"),
    )


@query("network_rates", _directions(NETWORK))
def _(spark, sf):
    return _io(metrics.network_rates(_containers(spark, sf), RATE_WINDOW_S))


@query("disk_rates", _directions(DISK))
def _(spark, sf):
    return _io(metrics.disk_rates(_containers(spark, sf), RATE_WINDOW_S))


@query("network_rates_2m", _directions(NETWORK, "panel_rates"))
def _(spark, sf):
    return _io(metrics.network_rates(_containers(spark, sf), PANEL_WINDOW_S))


@query("disk_rates_2m", _directions(DISK, "panel_rates"))
def _(spark, sf):
    return _io(metrics.disk_rates(_containers(spark, sf), PANEL_WINDOW_S))


@query("cpu_percent_2m", "select * from panel_cpu")
def _(spark, sf):
    return metrics.cpu_percent(_containers(spark, sf), PANEL_WINDOW_S).select(
        "name", "ts", _six("value")
    )


@query("cpu_status", """
    select name, value, case when value >= 1.0 then 'red' when value >= 0.5 then 'yellow' else 'green' end as status
    from (select name, arg_max(value, ts) as value from cpu where value is not null group by name) c
    order by value desc, name""")
def _(spark, sf):
    return metrics.cpu_status(_containers(spark, sf), RATE_WINDOW_S).withColumn("value", _six("value"))


@query("rank_current_memory", f"select name, arg_max(value, ts) as value, "
       f"case when arg_max(value, ts) >= 1073741824 then 'red' "
       f"when arg_max(value, ts) >= 536870912 then 'yellow' else 'green' end as status "
       f"from memory where metric = '{MEMORY}' and name <> '' group by name")
def _(spark, sf):
    ranked = metrics.rank_current(metrics.memory_by_name(_memory(spark, sf)))
    return ranked.withColumn("status", threshold_status(F.col("value"), MEMORY_STEPS))


@query("rank_current_cpu", "select name, arg_max(value, ts) as value from cpu "
       "where value is not null group by name order by 2 desc, 1")
def _(spark, sf):
    cpu = metrics.cpu_percent(_containers(spark, sf), RATE_WINDOW_S)
    known = cpu.where(F.col("value").isNotNull())
    return metrics.rank_current(known).select("name", _six("value"))


_STEP_S = 1800
_STALE_S = 2 * 3600


def _growth_sql(names, stale_s=None):
    """Carried on to the end, or until the value is stale."""
    listed = ", ".join(f"'{name}'" for name in names)
    seen, kept = "count(v.ts)", "seen > 0"
    if stale_s is not None:
        seen, kept = "max(v.ts)", f"ts < seen + interval {stale_s} second"
    return f"""
    select metric, ts, value from (
        select g.metric, g.ts,
               last_value(v.value ignore nulls) over (partition by g.metric order by g.ts) as value,
               {seen} over (partition by g.metric order by g.ts) as seen
        from (select m.metric, t.ts from (select distinct metric from lake_readings
                                           where metric in ({listed})) m,
                     (select unnest(generate_series(timestamp '{RANGE[0]}',
                                                    timestamp '{RANGE[1]}',
                                                    interval {_STEP_S} second)) as ts) t) g
        left join (select metric, time_bucket(interval {_STEP_S} second, ts) as ts,
                          arg_max(value, ts) as value
                   from lake_readings
                   where value is not null
                     and ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'
                   group by 1, 2) v using (metric, ts)
    ) filled where {kept}"""


_LAKE_GROWTH = ("lake_snapshots", "lake_data_files")
_STORAGE = ("lake_storage_bytes",)


def _growth(spark, sf, names, stale_s=None):
    known = _readings(spark, sf).where(F.col("value").isNotNull())
    return metrics.growth(known, names, _STEP_S, *RANGE, stale_after_s=stale_s)


@query("lake_growth", _growth_sql(_LAKE_GROWTH))
def _(spark, sf):
    return _growth(spark, sf, _LAKE_GROWTH)


@query("lake_growth_until_stale", _growth_sql(_LAKE_GROWTH, _STALE_S))
def _(spark, sf):
    return _growth(spark, sf, _LAKE_GROWTH, _STALE_S)


@query("storage_growth", _growth_sql(_STORAGE))
def _(spark, sf):
    return _growth(spark, sf, _STORAGE)


@query("storage_growth_until_stale", _growth_sql(_STORAGE, _STALE_S))
def _(spark, sf):
    return _growth(spark, sf, _STORAGE, _STALE_S)


@query("lake_current", """
    select metric, value,
           case metric
               when 'lake_snapshot_age_seconds'
                   then case when value >= 3600 then 'red' when value >= 300 then 'yellow'
                             else 'green' end
               when 'lake_files_pending_deletion'
                   then case when value >= 1 then 'red' else 'green' end
               when 'lake_snapshots_per_hour' then 'green'
               when 'lake_storage_bytes' then 'green'
               when 'lake_tables' then 'purple'
               else 'blue' end as status
    from (select metric, arg_max(value, ts) as value from lake_readings
          where value is not null and not starts_with(metric, 'lake_table_')
            and metric <> 'lake_data_files'
          group by metric) m""")
def _(spark, sf):
    return metrics.current(_readings(spark, sf))


@query("lake_table_current", """
    select metric, schema_label || '.' || table_part as table_label,
           arg_max(value, ts) as value
    from lake_readings
    where value is not null and starts_with(metric, 'lake_table_') group by 1, 2""")
def _(spark, sf):
    readings = _readings(spark, sf)
    per_table = readings.where(F.col("metric").isin(*lakehouse.TABLE_GAUGES.values()))
    return metrics.current_by_table(per_table)
