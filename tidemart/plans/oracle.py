"""The same results as ANSI SQL, for the side-by-side check on DuckDB.

``RELATIONS`` holds named sub-relations; ``check_sql`` prepends those a query
needs. Money is summed as it is and only sums are rounded. The operators do not
round them; their queries do, for the comparison only (``queries_models.shown``).
"""

from __future__ import annotations

import re

from tidemart.plans.inputs import AS_OF, FIRST_LOAD_UNTIL, LAKE_GAUGES, RUN_DATE
from tidemart.operators.metrics import CPU, DISK, MEMORY, MEMORY_LIMIT, NETWORK


def money(value: str) -> str:
    return (
        f"('$' || cast(cast(round(cast({value} as decimal(38,10)), 2) as decimal(38,2)) "
        "as varchar))"
    )


def rounded(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,10)), {digits}) as double)"


def exact(value: str, scale: int) -> str:
    return f"round(sum({value}), {scale})"


def whole(value: str) -> str:
    return f"cast({value} as bigint)"


_GAUGE_CASE = "case user_id % {n} {arms} end".format(
    n=len(LAKE_GAUGES),
    arms=" ".join(f"when {i} then '{name}'" for i, name in enumerate(LAKE_GAUGES)),
)
_STATE = (
    "case when event_type in ('purchase', 'click') then 'success' "
    "when event_type = 'error' then 'failed' "
    "when event_type = 'view' then 'running' else 'queued' end"
)
_K = "cast(json_extract_string(props, '$.k') as bigint)"
_NAME = "case when user_id % 20 = 0 then '' else 'c' || (user_id % 20) end"


def rate_sql(relation: str, window_s: int, keys: str) -> str:
    """Reset-aware rate, written as one range frame per whole series."""
    span = window_s * 1_000_000 - 1
    frame = (
        f"(partition by {keys} order by us range between {span} preceding and current row)"
    )
    return f"""
    select s.*, (sum(step) over {frame} - first_value(step) over {frame})
               / nullif((us - min(us) over {frame}) / 1000000.0, 0) as rate
    from (
        select d.*, coalesce(case when value < prior then value else value - prior end, 0) as step
        from (
            select r.*, epoch_us(ts) as us,
                   lag(value) over (partition by {keys} order by ts) as prior
            from {relation} r
        ) d
    ) s"""


RATE_WINDOW_S = 7200
PANEL_WINDOW_S = 120

RELATIONS = {
    "stg_customers": """
        select c_custkey as customer_id, c_name as customer_name,
               cast(null as varchar) as phone, cast(null as varchar) as address,
               c_acctbal as account_balance, c_mktsegment as market_segment,
               c_nationkey as nation_key
        from customer""",
    "stg_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, o_totalprice as order_amount,
               o_orderdate as order_date, o_orderstatus as order_status,
               o_orderpriority as order_priority, cast(null as varchar) as clerk
        from orders""",
    "stg_lineitem": """
        select l_orderkey as order_id, l_linenumber as line_number, l_quantity as quantity,
               l_extendedprice as extended_price, l_discount as discount, l_tax as tax,
               l_extendedprice * (1 - l_discount) as net_price,
               l_extendedprice * (1 - l_discount) * (1 + l_tax) as gross_price,
               l_returnflag as return_flag, l_linestatus as line_status,
               l_shipdate as ship_date, cast(null as timestamp) as commit_date,
               cast(null as varchar) as ship_mode
        from lineitem""",
    "spend": f"""
        select customer_id, count(*) as total_orders, {exact("order_amount", 2)} as total_spent,
               min(order_date) as first_order_date, max(order_date) as last_order_date,
               count(*) filter (where order_status = 'O') as open_orders,
               count(*) filter (where order_status = 'F') as fulfilled_orders
        from stg_orders group by all""",
    "customer_orders": """
        select customer_id, customer_name, phone, market_segment, account_balance,
               ifnull(total_orders, 0) as total_orders, ifnull(total_spent, 0.0) as total_spent,
               ifnull(open_orders, 0) as open_orders,
               ifnull(fulfilled_orders, 0) as fulfilled_orders,
               first_order_date, last_order_date
        from stg_customers left join spend using (customer_id)""",
    "line_totals": f"""
        select order_id, {exact("net_price", 4)} as net_revenue,
               {exact("gross_price", 6)} as gross_revenue,
               {exact("quantity", 2)} as total_quantity, count(*) as line_count,
               count(*) filter (where return_flag = 'R') as returned_lines
        from stg_lineitem group by all""",
    "order_revenue": f"""
        select order_id, customer_id, order_date, order_status, order_priority, clerk,
               order_amount as list_price, net_revenue, gross_revenue, total_quantity,
               line_count, returned_lines,
               {rounded("net_revenue / nullif(total_quantity, 0)", 2)} as avg_net_price_per_unit,
               {rounded("100.0 * returned_lines / nullif(line_count, 0)", 2)} as return_rate_pct
        from stg_orders left join line_totals using (order_id)""",
    "run_log": f"""
        select 'dag_' || (user_id % 10) as dag_id, {_STATE} as state, ts as execution_date,
               ts as start_date,
               case when event_type in ('purchase', 'click', 'error')
                    then ts + to_microseconds(cast(round(value * 1000000) as bigint))
               end as end_date
        from events""",
    "task_log": f"""
        select 'dag_' || (user_id % 10) as dag_id, event_type as task_id, {_STATE} as state,
               ts as start_date,
               case when event_type in ('purchase', 'click', 'error') then value end as duration
        from events""",
    **{
        name: f"""
        select cast(ts as date) as event_date, cast(user_id as varchar) as artist_id,
               cast({_K} as varchar) as track_id, count(*) as streams,
               cast(null as decimal(38,9)) as revenue, 'source_a' as source,
               max(ts) as updated_at
        from events where event_type = 'view' and {cut} group by all"""
        for name, cut in (
            ("source_a", "true"), ("old_a", f"ts < timestamp '{FIRST_LOAD_UNTIL}'")
        )
    },
    **{
        name: f"""
        select cast(ts as date) as event_date, cast(user_id as varchar) as artist_id,
               cast({_K} as varchar) as track_id, count(*) as streams,
               case when {_K} % 10 = 0 then null
                    else cast(sum(cast(value as decimal(18,2))) as decimal(38,9)) end as revenue,
               'source_b' as source, max(ts) as updated_at
        from events where event_type = 'purchase' and {cut}
        group by event_date, artist_id, {_K}"""
        for name, cut in (
            ("source_b", "true"), ("old_b", f"ts < timestamp '{FIRST_LOAD_UNTIL}'")
        )
    },
    "fact": "select * from source_a union all select * from source_b",
    "old_fact": """
        select * replace (streams + 1000 as streams)
        from (select * from old_a union all select * from old_b) f""",
    "fresh": f"select * from fact where event_date >= date '{RUN_DATE}' - 7",
    "merged": """
        select * from fresh union all
        select * from old_fact o where not exists (
            select 1 from fresh f
            where (f.event_date, f.artist_id, f.track_id, f.source)
                = (o.event_date, o.artist_id, o.track_id, o.source))""",
    "artist_daily": """
        select event_date, artist_id, source, cast(sum(streams) as bigint) as streams,
               sum(revenue) as revenue, count(distinct track_id) as tracks
        from fact group by all""",
    "snapshots": "select distinct o_orderdate as snapshot_time from orders",
    "lake_table_rows": """
        select c_custkey as table_id, cast(c_nationkey as bigint) as schema_id,
               c_name as table_name,
               case when c_mktsegment = 'MACHINERY' then cast(1 as bigint) end as end_snapshot
        from customer""",
    "lake_schema_rows": """
        select cast(n_nationkey as bigint) as schema_id, n_name as schema_name,
               case when n_regionkey = 4 then cast(1 as bigint) end as end_snapshot
        from nation""",
    "lake_files": """
        select o_orderkey as data_file_id, o_custkey as table_id,
               cast(floor(o_totalprice) as bigint) as file_size_bytes,
               cast(floor(o_totalprice / 100) as bigint) as record_count,
               case when o_orderstatus = 'P' then cast(1 as bigint) end as end_snapshot
        from orders""",
    "per_table": """
        select schema_name, table_name, count(data_file_id) as file_count,
               cast(ifnull(sum(file_size_bytes), 0) as bigint) as total_bytes,
               cast(ifnull(sum(record_count), 0) as bigint) as total_records
        from (select * from lake_table_rows where end_snapshot is null) t
        join (select * from lake_schema_rows where end_snapshot is null) s using (schema_id)
        left join (select * from lake_files where end_snapshot is null) f using (table_id)
        group by schema_name, table_name""",
    "lake_totals": f"""
        select (select count(*) from snapshots) as snapshots,
               (select count(*) from snapshots
                where snapshot_time >= timestamp '{AS_OF}' - interval 1 hour)
                   as snapshots_per_hour,
               (select epoch_us(timestamp '{AS_OF}') - epoch_us(max(snapshot_time))
                from snapshots) / 1000000.0 as snapshot_age,
               (select count(*) from lake_table_rows where end_snapshot is null) as tables,
               (select count(*) from lake_schema_rows where end_snapshot is null) as schemas,
               (select count(*) from lake_files where end_snapshot is null) as data_files,
               (select cast(sum(file_size_bytes) as bigint) from lake_files
                where end_snapshot is null) as storage_bytes,
               (select cast(sum(record_count) as bigint) from lake_files
                where end_snapshot is null) as records,
               (select count(*) from orders where o_orderstatus = 'P') as pending_deletion""",
    "samples": f"""
        select case event_type when 'click' then '{CPU}' when 'signup' then '{NETWORK["rx"]}'
                    when 'error' then '{NETWORK["tx"]}' when 'purchase' then '{DISK["read"]}'
                    when 'view' then '{DISK["write"]}' end as metric,
               {_NAME} as name, cast(user_id as varchar) as instance, ts, value
        from events""",
    "rates": rate_sql("samples", RATE_WINDOW_S, "metric, name, instance"),
    "panel_rates": rate_sql("samples", PANEL_WINDOW_S, "metric, name, instance"),
    "panel_cpu": f"""
        select name, ts, {rounded("sum(rate) * 100", 6)} as value
        from panel_rates where metric = '{CPU}' and name <> '' group by name, ts""",
    "cpu": f"""
        select name, ts, {rounded("sum(rate) * 100", 6)} as value
        from rates where metric = '{CPU}' and name <> '' group by name, ts""",
    "memory": f"""
        select case event_type when 'purchase' then '{MEMORY_LIMIT}' else '{MEMORY}' end as metric,
               {_NAME} as name, date_trunc('hour', ts) as ts,
               max(case when event_type = 'purchase' and hour(ts) % 7 = 0 then 0
                        else value end) as value
        from events where event_type in ('view', 'purchase')
        group by 1, 2, 3""",
    "lake_readings": f"""
        select {_GAUGE_CASE} as metric, 's' || (user_id % 3) as schema_label,
               't' || ({_K} % 5) as table_part, ts,
               case when {_K} % 10 <> 0 then value end as value
        from events""",
}


def check_sql(body: str) -> str:
    """``body`` preceded by the relations it names, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(RELATIONS[name])

    visit(body)

    def place(name: str, done: list[str]) -> None:
        if name in done:
            return
        for other in RELATIONS:
            if other != name and re.search(rf"\b{other}\b", RELATIONS[name]):
                place(other, done)
        done.append(name)

    ordered: list[str] = []
    for name in RELATIONS:
        if name in needed:
            place(name, ordered)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{name} as ({RELATIONS[name]})" for name in ordered)
    return f"with {parts}\n{body.strip()}"
