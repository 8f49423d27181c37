"""Predicates and scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart import functions as fn
from tidemart.functions.status import SUCCESS_RATE_STEPS
from tidemart.functions.times import instant_like
from tidemart.operators import filters, staging
from tidemart.plans import inputs
from tidemart.plans.inputs import AS_OF, RANGE, RUN_DATE
from tidemart.plans.oracle import money, rounded
from tidemart.plans.queries_models import models, shown
from tidemart.plans.registry import query
from tidemart.sources.tables import scan_source


def runs(spark, sf):
    return inputs.run_log(inputs.events(spark, sf))


def fact_rows(spark, sf):
    return inputs.fact(inputs.events(spark, sf))


def comparable(df):
    """Dates as text, decimals as double and instants without zone, for the value check."""
    kinds = {
        "date": lambda c: c.cast("string"),
        "timestamp": lambda c: c.cast("timestamp_ntz"),
    }
    return df.select(
        *[
            (
                F.col(f.name).cast("double")
                if f.dataType.typeName() == "decimal"
                else kinds.get(f.dataType.typeName(), lambda c: c)(F.col(f.name))
            ).alias(f.name)
            for f in df.schema
        ]
    )


FACT_SELECT = (
    "select cast(event_date as varchar) as event_date, artist_id, track_id, streams, "
    "cast(revenue as double) as revenue, source, updated_at"
)


@query("live_rows", "select * from lake_files where end_snapshot is null")
def _(spark, sf):
    return filters.live_rows(inputs.lake_catalog(spark, sf)["files"])


@query("since_interval", f"select dag_id, state, execution_date from run_log "
       f"where execution_date >= timestamp '{AS_OF}' - interval 7 day")
def _(spark, sf):
    recent = filters.since_interval(runs(spark, sf), "execution_date", AS_OF, "7 days")
    return recent.select("dag_id", "state", "execution_date")


@query("rolling_reprocess_window", f"{FACT_SELECT} from fact "
       f"where event_date >= date '{RUN_DATE}' - 7")
def _(spark, sf):
    return comparable(filters.rolling_reprocess_window(fact_rows(spark, sf), RUN_DATE))


@query("time_range", f"select dag_id, state, execution_date from run_log "
       f"where execution_date between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'")
def _(spark, sf):
    shown = filters.time_range(runs(spark, sf), "execution_date", *RANGE)
    return shown.select("dag_id", "state", "execution_date")


@query("state_equals", "select dag_id, execution_date from run_log where state = 'failed'")
def _(spark, sf):
    return filters.state_equals(runs(spark, sf), "failed").select("dag_id", "execution_date")


@query("state_in", "select dag_id, state, execution_date from run_log "
       "where state = 'failed' or state = 'success'")
def _(spark, sf):
    finished = filters.state_in(runs(spark, sf), "success", "failed")
    return finished.select("dag_id", "state", "execution_date")


@query("is_not_null", "select dag_id, state, end_date from run_log where end_date is not null")
def _(spark, sf):
    return filters.is_not_null(runs(spark, sf), "end_date").select("dag_id", "state", "end_date")


@query("between_dates_and_key", f"""{FACT_SELECT} from fact
       where event_date between date '{RANGE[0][:10]}' and date '{RANGE[1][:10]}'
         and artist_id = '7'""")
def _(spark, sf):
    days = (RANGE[0][:10], RANGE[1][:10])
    return comparable(filters.between_dates_and_key(fact_rows(spark, sf), *days, "7"))


@query("min_orders", "select customer_id, total_orders from customer_orders "
       "where total_orders > 2")
def _(spark, sf):
    kept = filters.min_orders(models(spark, sf)["customer_orders"], 2)
    return kept.select("customer_id", "total_orders")


@query("label_nonempty", "select metric, name, ts, value from samples where name <> ''")
def _(spark, sf):
    named = filters.label_nonempty(inputs.container_samples(inputs.events(spark, sf)))
    return named.select("metric", F.col("labels")["name"].alias("name"), "ts", "value")


@query("positive_limit", "select metric, name, ts, value from memory where value > 0")
def _(spark, sf):
    kept = filters.positive_limit(inputs.memory_samples(inputs.events(spark, sf)), "value")
    return kept.select("metric", F.col("labels")["name"].alias("name"), "ts", "value")


@query("prefix_like", "select customer_id, market_segment from stg_customers "
       "where market_segment like 'MA%'")
def _(spark, sf):
    kept = filters.prefix_like(models(spark, sf)["stg_customers"], "market_segment", "MA")
    return kept.select("customer_id", "market_segment")


@query("net_price", "select order_id, line_number, net_price from stg_lineitem")
def _(spark, sf):
    price, discount = F.col("extended_price"), F.col("discount")
    return models(spark, sf)["stg_lineitem"].select(
        "order_id", "line_number", fn.net_price(price, discount).alias("net_price")
    )


@query("gross_price", "select order_id, line_number, gross_price from stg_lineitem")
def _(spark, sf):
    price, discount, tax = F.col("extended_price"), F.col("discount"), F.col("tax")
    return models(spark, sf)["stg_lineitem"].select(
        "order_id", "line_number", fn.gross_price(price, discount, tax).alias("gross_price")
    )


@query("stg_source_a", f"{FACT_SELECT} from source_a")
def _(spark, sf):
    return comparable(inputs.staged_sources(inputs.events(spark, sf))[0])


@query("stg_source_b", f"{FACT_SELECT} from source_b")
def _(spark, sf):
    return comparable(inputs.staged_sources(inputs.events(spark, sf))[1])


@query("exclusive_fields_json", """
    select o_orderkey,
           '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' as extra
    from orders""")
def _(spark, sf):
    orders = scan_source(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return staging.pack_extra(orders, ["o_orderkey"])


@query("coalesce", "select order_id, ifnull(net_revenue, 0.0) as net_revenue, "
       "ifnull(line_count, 0) as line_count from order_revenue")
def _(spark, sf):
    return shown(models(spark, sf)["order_revenue"].select(
        "order_id",
        F.coalesce("net_revenue", F.lit(0.0)).alias("net_revenue"),
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
    ))


@query("nullif", "select l_orderkey, l_linenumber, case when l_tax <> 0 then l_tax end as tax, "
       "case when l_tax <> 0 then l_discount / l_tax end as discount_per_tax from lineitem")
def _(spark, sf):
    tax = F.col("l_tax")
    return scan_source(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.nullif(tax, F.lit(0.0)).alias("tax"),
        fn.ratio(F.col("l_discount"), tax).alias("discount_per_tax"),
    )


@query("round", f"select l_orderkey, l_linenumber, "
       f"{rounded('l_extendedprice / l_quantity', 2)} as unit_price, "
       f"{rounded('l_extendedprice / l_quantity', 1)} as unit_price_1 from lineitem")
def _(spark, sf):
    unit = fn.ratio(F.col("l_extendedprice"), F.col("l_quantity"))
    return scan_source(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        fn.round_to(unit, 2).alias("unit_price"), fn.round_to(unit, 1).alias("unit_price_1"),
    )


@query("case_when", "select order_id, case order_status when 'O' then 'open' "
       "when 'F' then 'fulfilled' else 'partial' end as status_text from stg_orders")
def _(spark, sf):
    status = F.col("order_status")
    text = F.when(status == "O", "open").when(status == "F", "fulfilled").otherwise("partial")
    return models(spark, sf)["stg_orders"].select("order_id", text.alias("status_text"))


@query("money_text", f"select l_orderkey, l_linenumber, "
       f"{money('l_extendedprice / 8')} as amount from lineitem")
def _(spark, sf):
    return scan_source(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.money_text(F.col("l_extendedprice") / 8).alias("amount")
    )


@query("cast_date", "select event_id, cast(cast(ts as date) as varchar) as event_date, "
       "cast(user_id as varchar) as artist_id, "
       "cast(cast(value as decimal(18,1)) as double) as tenths from events")
def _(spark, sf):
    return inputs.events(spark, sf).select(
        "event_id",
        F.to_date("ts").cast("string").alias("event_date"),
        F.col("user_id").cast("string").alias("artist_id"),
        F.col("value").cast("decimal(18,1)").cast("double").alias("tenths"),
    )


@query("safe_cast", """
    select event_id, try_cast(case when value < 1 then 'n/a' else cast(value as varchar) end
                              as double) as revenue from events""")
def _(spark, sf):
    text = F.when(F.col("value") < 1, "n/a").otherwise(F.col("value").cast("string"))
    return inputs.events(spark, sf).select(
        "event_id", fn.safe_cast(text, "double").alias("revenue")
    )


@query("typed_null", "select event_id, cast(null as double) as revenue from events")
def _(spark, sf):
    return inputs.events(spark, sf).select(
        "event_id", fn.typed_null("double").alias("revenue")
    )


@query("source_tag", "select event_id, 'source_a' as source from events")
def _(spark, sf):
    return inputs.events(spark, sf).select("event_id", F.lit("source_a").alias("source"))


@query("now", f"select c_custkey as customer_id, timestamp '{AS_OF}' as loaded_at from customer")
def _(spark, sf):
    staged = staging.stg_customers(scan_source(spark, sf, "customer"), AS_OF)
    return staged.select(
        "customer_id", F.col("_loaded_at").cast("timestamp_ntz").alias("loaded_at")
    )


@query("epoch_seconds", "select dag_id, execution_date, "
       "(epoch_us(end_date) - epoch_us(start_date)) / 1000000.0 as seconds from run_log")
def _(spark, sf):
    seconds = fn.epoch_seconds(F.col("end_date"), F.col("start_date"))
    return runs(spark, sf).select("dag_id", "execution_date", seconds.alias("seconds"))


@query("date_trunc_hour", "select event_id, cast(date_trunc('hour', ts) as timestamp) as hour "
       "from events")
def _(spark, sf):
    log = inputs.events(spark, sf)
    return log.select("event_id", fn.hour_bucket(log, "ts").alias("hour"))


@query("date_sub", "select event_id, cast(cast(ts as date) - 7 as varchar) as week_before "
       "from events")
def _(spark, sf):
    return inputs.events(spark, sf).select(
        "event_id", F.date_sub(F.to_date("ts"), 7).cast("string").alias("week_before")
    )


@query("interval_arith", f"select event_id, ts - interval 1 hour as hour_before, "
       f"ts >= timestamp '{AS_OF}' - interval 7 day as in_window from events")
def _(spark, sf):
    log = inputs.events(spark, sf)
    bound = instant_like(log, "ts", AS_OF) - F.expr("INTERVAL 7 DAYS")
    return log.select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("hour_before"),
        (F.col("ts") >= bound).alias("in_window"),
    )


@query("table_label", "select event_type || '.' || user_id as table_label, event_id from events")
def _(spark, sf):
    return inputs.events(spark, sf).select(
        fn.table_label(F.col("event_type"), F.col("user_id").cast("string")).alias("table_label"),
        "event_id",
    )


@query("threshold_status", "select event_id, case when value >= 95 then 'green' "
       "when value >= 80 then 'yellow' else 'red' end as status from events")
def _(spark, sf):
    return inputs.events(spark, sf).select(
        "event_id", fn.threshold_status(F.col("value"), SUCCESS_RATE_STEPS).alias("status")
    )


@query("arith", "select l_orderkey, l_linenumber, l_quantity * l_tax + l_discount as mixed, "
       "l_tax * 100 as tax_pct from lineitem")
def _(spark, sf):
    return scan_source(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") * F.col("l_tax") + F.col("l_discount")).alias("mixed"),
        (F.col("l_tax") * 100).alias("tax_pct"),
    )
