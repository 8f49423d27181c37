"""Writers, the platform fact, data quality and streams.

Queries that write do so below the shared folder and return what they read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemart.functions import round_to
from tidemart.operators import joins, quality, reports, unified
from tidemart.operators.filters import rolling_reprocess_window
from tidemart.plans import inputs
from tidemart.plans.inputs import RANGE, RUN_DATE
from tidemart.plans.models import run_daily
from tidemart.plans.oracle import money, rounded
from tidemart.plans.queries_columns import FACT_SELECT, comparable, fact_rows
from tidemart.plans.queries_models import models, shown
from tidemart.plans.registry import query
from tidemart.schemas import FACT_DDL, SEED_ORDERS, check_contract, contract_report
from tidemart.session import fresh_path
from tidemart.sources import facts, tables
from tidemart.streaming import streams

LOADED = ("customer", "orders", "lineitem", "supplier", "nation", "region", "part")
DAYS = (RANGE[0][:10], RANGE[1][:10])
_IN_DAYS = f"event_date between date '{DAYS[0]}' and date '{DAYS[1]}'"


def _database():
    return f"check_{uuid.uuid4().hex[:12]}"


def _log(spark, sf):
    return inputs.events(spark, sf)


@query("load_raw_if_absent", " union all ".join(
    f"select '{t}' as \"table\", count(*) as rows, true as skipped from {t}" for t in LOADED
))
def _(spark, sf):
    raw, folder = _database(), fresh_path(spark, "raw")
    tables.load_raw(spark, sf, raw, LOADED[:3], location=folder)
    tables.load_raw(spark, sf, raw, LOADED, location=folder)
    return tables.load_raw(spark, sf, raw, LOADED, location=folder)


@query("materialize_table", "select * from customer_orders")
def _(spark, sf):
    mart = models(spark, sf)["customer_orders"]
    return shown(tables.materialize(mart, f"{_database()}.customer_orders", fresh_path(spark, "marts")))


def _orders_as_csv(spark, sf):
    """The orders as a CSV file with header, in the columns of the order seed."""
    path = fresh_path(spark, "seed")
    models(spark, sf)["stg_orders"].select(
        "order_id", "customer_id", F.to_date("order_date").alias("order_date"),
        F.col("order_amount").cast("decimal(18,2)").alias("order_amount"),
    ).write.csv(path, header=True)
    return path


def _seed(spark, sf):
    name = f"{_database()}.raw_orders"
    tables.load_seed(spark, _orders_as_csv(spark, sf), SEED_ORDERS, name,
                     fresh_path(spark, "seeds"))
    return name


_SEED_SELECT = (
    "select cast(order_id as integer) as order_id, cast(customer_id as integer) as customer_id, "
    "cast(cast(order_date as date) as varchar) as order_date, "
)


@query("load_seed_csv", f"{_SEED_SELECT} order_amount from stg_orders")
def _(spark, sf):
    return comparable(spark.table(_seed(spark, sf)))


@query("scan_seed", f"{_SEED_SELECT} order_amount from stg_orders")
def _(spark, sf):
    return comparable(tables.scan_seed(spark, _seed(spark, sf)))


@query("raw_orders_by_date", f"{_SEED_SELECT} {money('order_amount')} as amount "
       "from stg_orders order by order_date desc, order_id")
def _(spark, sf):
    return comparable(reports.raw_orders(tables.scan_seed(spark, _seed(spark, sf))))


@query("write_fact_partitioned", f"{FACT_SELECT} from fact")
def _(spark, sf):
    path = fresh_path(spark, "fact")
    facts.write_fact(fact_rows(spark, sf), path)
    return comparable(facts.read_all(spark, path))


@query("require_partition_filter", f"select f.*, true as refused from ({FACT_SELECT} from fact where {_IN_DAYS}) f")
def _(spark, sf):
    path = fresh_path(spark, "fact")
    facts.write_fact(fact_rows(spark, sf), path)
    try:
        facts.read_fact(spark, path, None, DAYS[1])
        refused = False
    except ValueError:
        refused = True
    return comparable(facts.read_fact(spark, path, *DAYS)).withColumn("refused", F.lit(refused))


@query("append_incremental", f"{FACT_SELECT} from fact")
def _(spark, sf):
    # The table has a part of its last date only; the second call finds nothing left to append.
    path, fact = fresh_path(spark, "fact"), fact_rows(spark, sf)
    last = F.lit(DAYS[0]).cast("date")
    early = (F.col("event_date") < last) | ((F.col("event_date") == last) & (F.col("streams") % 2 == 1))
    facts.write_fact(fact.where(early), path)
    for _ in range(2):
        facts.append_new(fact, path)
    return comparable(facts.read_all(spark, path))


_DASH = (
    "select cast(event_date as varchar) as event_date, artist_id, source, streams, "
    "cast(revenue as double) as revenue, tracks from artist_daily"
)


def _dashboard(spark, sf):
    return unified.dashboard_artist_daily(fact_rows(spark, sf))


@query("dashboard_artist_daily", _DASH)
def _(spark, sf):
    return comparable(_dashboard(spark, sf))


@query("write_dashboard_partitioned", _DASH)
def _(spark, sf):
    path = fresh_path(spark, "dashboard")
    facts.write_dashboard(_dashboard(spark, sf), path)
    return comparable(facts.read_all(spark, path, schema=None))


@query("query_dashboard", "select cast(event_date as varchar) as event_date, source, streams, "
       f"cast(revenue as double) as revenue from artist_daily "
       f"where artist_id = '7' and {_IN_DAYS}")
def _(spark, sf):
    path = fresh_path(spark, "dashboard")
    facts.write_dashboard(_dashboard(spark, sf), path)
    mart = facts.read_fact(spark, path, *DAYS, schema=None)
    return comparable(unified.query_dashboard(mart, *DAYS, "7"))


@query("union_all_sources", f"{FACT_SELECT} from fact")
def _(spark, sf):
    return comparable(unified.union_all_sources(*inputs.staged_sources(_log(spark, sf))))


def _contract_sql():
    """Of the fact, and of a copy with a measure as text, without a column and with another one instead."""
    kinds = {"DATE": "date", "VARCHAR": "string", "BIGINT": "bigint", "DECIMAL(38,9)": "decimal(38,9)", "TIMESTAMP": "timestamp",
             "TIMESTAMP WITH TIME ZONE": "timestamp"}
    found = "case any_value(typeof({c})) " + " ".join(f"when '{a}' then '{b}'" for a, b in kinds.items()) + " end"
    rows = []
    bad = ("(select event_date, artist_id, track_id, cast(streams as varchar) as streams, revenue, source as note, "
           "updated_at from fact) b")
    for name, source, swapped in (("good", "fact", None), ("bad", bad, "note")):
        for place, field in enumerate(FACT_DDL.split(", "), 1):
            column, kind = field.split(" ")
            there = column != "source" or not swapped
            rows.append(f"select '{name}' as input, '{column}' as \"column\", {place} as place, '{kind}' as expected, "
                        + (f"{found.format(c=column)} as found, count({column}) as filled, {found.format(c=column)} = '{kind}' as ok"
                           if there else "null as found, 0 * count(*) as filled, false as ok") + f" from {source}")
    rows.append(f"select 'bad', 'note', null, null, {found.format(c='note')}, count(note), false from {bad}")
    return " union all ".join(rows)


@query("dq_schema_contract", f"{FACT_SELECT} from fact")
def _(spark, sf):
    return comparable(check_contract(fact_rows(spark, sf), FACT_DDL))


@query("dq_contract_report", _contract_sql())
def _(spark, sf):
    good = fact_rows(spark, sf)
    bad = good.withColumn("streams", F.col("streams").cast("string")).withColumnRenamed("source", "note")
    return contract_report("good", good, FACT_DDL).unionByName(contract_report("bad", bad, FACT_DDL))


@query("merge_upsert", f"{FACT_SELECT} from merged")
def merge_upsert(spark, sf):
    log = _log(spark, sf)
    fresh = rolling_reprocess_window(inputs.fact(log), RUN_DATE)
    return comparable(unified.merge_upsert(inputs.first_load(log), fresh))


@query("incremental_merge", f"{FACT_SELECT} from merged")
def _(spark, sf):
    log, path = _log(spark, sf), fresh_path(spark, "fact")
    facts.write_fact(inputs.first_load(log), path)
    unified.apply_incremental_merge(spark, path, inputs.staged_sources(log), RUN_DATE)
    return comparable(facts.read_all(spark, path))


@query("combine_grains", """
    select cast(month as varchar) as month, artist_id, streams, revenue from (
        select cast(date_trunc('month', event_date) as date) as month, artist_id,
               cast(sum(streams) as bigint) as streams
        from source_a group by all) d
    full join (
        select cast(date_trunc('month', event_date) as date) as month, artist_id,
               cast(sum(revenue) as double) as revenue
        from source_b group by all) m using (month, artist_id)""")
def _(spark, sf):
    daily, paid = inputs.staged_sources(_log(spark, sf))
    monthly = paid.withColumn("month", F.trunc("event_date", "month"))
    return comparable(joins.combine_grains(daily, monthly, ["month", "artist_id"]))


@query("dq_not_null", """
    select 'net_revenue' as "column", count(*) filter (where net_revenue is null) as failures
    from order_revenue union all
    select 'line_count', count(*) filter (where line_count is null) from order_revenue
    union all
    select 'order_id', count(*) filter (where order_id is null) from order_revenue""")
def _(spark, sf):
    mart = models(spark, sf)["order_revenue"]
    return quality.dq_not_null(mart, "net_revenue", "line_count", "order_id")


@query("dq_unique", "select order_id, line_number, count(*) as n_rows from stg_lineitem "
       "group by all having count(*) > 1")
def _(spark, sf):
    return quality.dq_unique(models(spark, sf)["stg_lineitem"], "order_id", "line_number")


@query("dq_relationships", """
    select count(*) as failures from stg_lineitem l
    where order_id is not null and (order_id % 7 = 0 or order_id not in (select order_id from stg_orders))""")
def _(spark, sf):
    # Every line has an order; some keys are turned negative so that there are orphans.
    m = models(spark, sf)
    key = F.col("order_id")
    lines = m["stg_lineitem"].withColumn("order_id", F.when(key % 7 == 0, -key - 1).otherwise(key))
    return quality.dq_relationships(lines, "order_id", m["stg_orders"], "order_id")


@query("dq_grain", """
    select cast(event_date as varchar) as event_date, artist_id, source, count(*) as n_rows
    from fact group by all having count(*) > 1""")
def _(spark, sf):
    # A grain without the track is too coarse for this fact, so there are violations.
    return comparable(quality.dq_grain(fact_rows(spark, sf), "event_date", "artist_id", "source"))


def _suite_sql():
    tests = []
    for model, declared in quality.DECLARED.items():
        for column in declared.not_null:
            tests.append((model, column, "not_null",
                          f"select count(*) from {model} where {column} is null"))
        if declared.unique:
            key = declared.unique
            tests.append((model, key, "unique",
                          f"select count(*) from (select {key} from {model} "
                          f"where {key} is not null group by {key} having count(*) > 1) d"))
        for column, parent, pkey in declared.relationships:
            tests.append((model, column, "relationships",
                          f"select count(*) from {model} c where {column} is not null and not "
                          f"exists (select 1 from {parent} p where p.{pkey} = c.{column})"))
    rows = " union all ".join(
        f"select '{model}' as model, '{column}' as \"column\", '{test}' as test, "
        f"({text}) as failures"
        for model, column, test, text in tests
    )
    return f"select *, failures = 0 as passed from ({rows}) t order by 1, 2, 3"


@query("dq_suite", _suite_sql())
def _(spark, sf):
    return quality.dq_suite(models(spark, sf))


@query("run_daily", _suite_sql())
def _(spark, sf):
    return run_daily(
        spark, sf, raw=_database(), marts=_database(), location=fresh_path(spark, "daily"),
        tables=LOADED,
    )


def _event_stream(spark, sf):
    schema = _log(spark, sf).schema
    session = streams.stream_session(spark)
    return session.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _drain(spark, df):
    """Run a stream over all its input and read the finished windows back."""
    path = fresh_path(spark, "windows")
    job = streams.stream_to_table(df, path, fresh_path(spark, "progress"), availableNow=True)
    job.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("stream_runs_per_hour", """
    select cast(date_trunc('hour', execution_date) as timestamp) as time,
           count(*) filter (where state = 'success') as success,
           count(*) filter (where state = 'failed') as failed,
           count(*) filter (where state = 'running') as running
    from run_log group by 1
    having date_trunc('hour', any_value(execution_date)) + interval 1 hour
           <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)""")
def _(spark, sf):
    runs = inputs.run_log(_event_stream(spark, sf))
    return comparable(_drain(spark, streams.stream_runs_per_hour(runs)))


@query("stream_metric_windows", f"""
    select window_start, window_start + interval 2 minute as window_end, metric, name, instance,
           {rounded("sum(value)", 6)} as sum, max(value) as max, arg_max(value, ts) as last
    from (select s.*, unnest([time_bucket(interval 30 second, ts) - interval 90 second,
                              time_bucket(interval 30 second, ts) - interval 60 second,
                              time_bucket(interval 30 second, ts) - interval 30 second,
                              time_bucket(interval 30 second, ts)]) as window_start
          from samples s) w
    where window_start + interval 2 minute
          <= (select date_trunc('millisecond', max(ts)) - interval 2 minute from events)
    group by window_start, metric, name, instance""")
def _(spark, sf):
    samples = inputs.container_samples(_event_stream(spark, sf))
    windows = _drain(spark, streams.stream_metric_windows(samples))
    labels = F.from_json("series", "map<string,string>")
    return comparable(windows).select(
        "window_start", "window_end", "metric", labels["name"].alias("name"),
        labels["instance"].alias("instance"), round_to(F.col("sum"), 6).alias("sum"), "max", "last",
    )


@query("stream_upsert_fact", f"""
    {FACT_SELECT} from (
        select event_date, artist_id, track_id, streams, revenue, source, updated_at
        from source_a union all
        select cast(ts as date), cast(user_id as varchar),
               cast(cast(json_extract_string(props, '$.k') as bigint) as varchar), count(*),
               sum(cast(value as decimal(18,2))), 'source_b', max(ts)
        from events where event_type = 'purchase' group by 1, 2, 3) f""")
def _(spark, sf):
    records = inputs.platform_records(_event_stream(spark, sf))
    path = fresh_path(spark, "fact")
    job = streams.stream_upsert(
        records, path, fresh_path(spark, "progress"), session=spark, availableNow=True
    )
    job.awaitTermination()
    return comparable(facts.read_all(spark, path))
