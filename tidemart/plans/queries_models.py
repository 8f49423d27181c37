"""Sources, staging, marts, joins and reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators import joins, marts, reports
from tidemart.plans.models import Models, build_models
from tidemart.plans.oracle import exact, money, rounded
from tidemart.plans.registry import query
from tidemart.sources.tables import as_view, preview, register_models, scan_source, sql

COUNTED = ("customer", "orders", "lineitem", "supplier", "nation", "region")


def models(spark: SparkSession, sf: str) -> Models:
    """The models without the load time, which differs from run to run."""
    built = build_models(spark, sf)
    return Models({name: lambda _, name=name: built[name].drop("_loaded_at") for name in built})


# Sums of doubles differ in their last bits between engines; the check compares this many digits.
SHOWN_DIGITS = {"total_spent": 2, "net_revenue": 4, "gross_revenue": 6, "total_quantity": 2}


def shown(df: DataFrame) -> DataFrame:
    """Sums rounded as the SQL rounds them; the marts themselves do not round."""
    return df.withColumns({name: F.round(name, digits) for name, digits in SHOWN_DIGITS.items() if name in df.columns})


@query("scan_source", "select * from lineitem")
def _(spark, sf):
    return scan_source(spark, sf, "lineitem")


@query("ref_model", "select order_id, customer_name, order_amount from stg_orders "
       "join stg_customers using (customer_id)")
def _(spark, sf):
    m = models(spark, sf)
    return m["stg_orders"].join(m["stg_customers"], "customer_id").select(
        "order_id", "customer_name", "order_amount"
    )


@query("materialize_view", "select market_segment, count(*) as customers "
       "from stg_customers group by all")
def _(spark, sf):
    view = as_view(models(spark, sf)["stg_customers"], "stg_customers")
    return view.groupBy("market_segment").agg(F.count(F.lit(1)).alias("customers"))


@query("adhoc_sql", "select order_priority, count(*) as orders, "
       "max(line_count) as most_lines from order_revenue group by all")
def _(spark, sf):
    register_models(models(spark, sf))
    return sql(
        spark,
        "SELECT order_priority, count(*) AS orders, max(line_count) AS most_lines "
        "FROM order_revenue GROUP BY order_priority",
    )


@query("preview", "select * from customer_orders order by customer_id limit 10")
def _(spark, sf):
    return shown(preview(models(spark, sf)["customer_orders"].orderBy("customer_id"), 10))


for _name in ("stg_customers", "stg_orders", "stg_lineitem", "customer_orders", "order_revenue"):
    query(_name, f"select * from {_name}")(lambda spark, sf, name=_name: shown(models(spark, sf)[name]))


@query("customer_order_summary", "select * from spend")
def _(spark, sf):
    return shown(marts.customer_order_summary(models(spark, sf)["stg_orders"]))


@query("revenue_by_order", "select * from line_totals")
def _(spark, sf):
    return shown(marts.revenue_by_order(models(spark, sf)["stg_lineitem"]))


@query("join_customers_left_summary", "select customer_id, customer_name, total_orders, "
       "last_order_date from stg_customers left join spend using (customer_id)")
def _(spark, sf):
    m = models(spark, sf)
    reduced = marts.customer_order_summary(m["stg_orders"])
    return joins.join_left(m["stg_customers"], reduced, "customer_id").select(
        "customer_id", "customer_name", "total_orders", "last_order_date"
    )


@query("join_orders_left_revenue", "select order_id, order_amount, net_revenue, line_count "
       "from stg_orders left join line_totals using (order_id)")
def _(spark, sf):
    m = models(spark, sf)
    reduced = marts.revenue_by_order(m["stg_lineitem"])
    return shown(joins.join_left(m["stg_orders"], reduced, "order_id").select(
        "order_id", "order_amount", "net_revenue", "line_count"
    ))


@query("join_revenue_inner_customer", "select order_id, customer_name, market_segment, "
       "net_revenue from order_revenue join stg_customers using (customer_id)")
def _(spark, sf):
    m = models(spark, sf)
    return shown(joins.join_inner_customer(m["order_revenue"], m["stg_customers"]).select(
        "order_id", "customer_name", "market_segment", "net_revenue"
    ))


@query("join_orders_inner_customer", "select order_id, customer_name, order_amount, order_date "
       "from stg_orders join stg_customers using (customer_id)")
def _(spark, sf):
    m = models(spark, sf)
    return joins.join_inner_customer(m["stg_orders"], m["stg_customers"]).select(
        "order_id", "customer_name", "order_amount", "order_date"
    )


@query("anti_join_orphans", """
    select order_key as orphan_key, count(*) as child_rows
    from (select case when l_orderkey % 7 = 0 then -l_orderkey - 1 else l_orderkey end as order_key from lineitem) l
    where not exists (select 1 from stg_orders o where o.order_id = l.order_key)
    group by all""")
def _(spark, sf):
    # Every line has an order; some keys are turned negative so that there are orphans.
    key = F.col("l_orderkey")
    lines = scan_source(spark, sf, "lineitem").withColumn("l_orderkey", F.when(key % 7 == 0, -key - 1).otherwise(key))
    return joins.anti_join_orphans(lines, "l_orderkey", models(spark, sf)["stg_orders"], "order_id")


@query("correlated_child_count", """
    select c.customer_id, c.customer_name,
           (select count(*) from stg_orders o where o.customer_id = c.customer_id) as child_count
    from stg_customers c""")
def _(spark, sf):
    m = models(spark, sf)
    return joins.correlated_child_count(
        m["stg_customers"].select("customer_id", "customer_name"), m["stg_orders"], "customer_id"
    )


_SPENT = f"{money('t.total_spent')} as total_spent, first_order_date, last_order_date"
_RANKED = "from customer_orders t order by t.total_spent desc, customer_id"


@query("top_customers", f"select customer_name, market_segment, total_orders, open_orders, "
       f"fulfilled_orders, {_SPENT} {_RANKED} limit 20")
def top_customers(spark, sf):
    return reports.top_customers(models(spark, sf)["customer_orders"])


@query("top_customers_5", f"select customer_name, total_orders, {_SPENT} {_RANKED} limit 5")
def _(spark, sf):
    return reports.customers_by_spend(models(spark, sf)["customer_orders"], 5)


@query("customers_by_spend", f"select customer_name, total_orders, {_SPENT} {_RANKED}")
def _(spark, sf):
    return reports.customers_by_spend(models(spark, sf)["customer_orders"])


@query("order_statistics", f"""
    select count(*) as total_customers, cast(sum(total_orders) as bigint) as total_orders,
           {money(exact("total_spent", 2))} as total_revenue,
           {money(exact("total_spent", 2) + " / count(total_spent)")} as avg_customer_value,
           {money("min(total_spent)")} as min_customer_value,
           {money("max(total_spent)")} as max_customer_value
    from customer_orders""")
def _(spark, sf):
    return reports.order_statistics(models(spark, sf)["customer_orders"])


_SEGMENT = f"""
    select market_segment, count(*) as total_orders,
           {money(exact("net_revenue", 4))} as net_revenue,
           {money(exact("net_revenue", 4) + " / count(net_revenue)")} as avg_order_revenue,
           {rounded(exact("return_rate_pct", 2) + " / count(return_rate_pct)", 2)}
               as avg_return_rate_pct
    from order_revenue join stg_customers using (customer_id)
    group by market_segment
    order by {exact("net_revenue", 4)} desc, market_segment"""


@query("revenue_by_segment", _SEGMENT)
def _(spark, sf):
    m = models(spark, sf)
    return reports.revenue_by_segment(m["order_revenue"], m["stg_customers"])


@query("order_by_aggregate", f"""
    select market_segment, count(*) as total_orders
    from order_revenue join stg_customers using (customer_id)
    group by market_segment order by {exact("net_revenue", 4)} desc, market_segment""")
def _(spark, sf):
    # By revenue, which itself is not shown.
    m = models(spark, sf)
    report = reports.revenue_by_segment(m["order_revenue"], m["stg_customers"])
    return report.select("market_segment", "total_orders")


@query("order_frequency_buckets", """
    select case total_orders when 1 then '1 order' when 2 then '2-3 orders'
                             when 3 then '2-3 orders' else '4+ orders' end as order_frequency,
           count(*) as customer_count
    from customer_orders group by 1""")
def _(spark, sf):
    return reports.order_frequency(models(spark, sf)["customer_orders"])


@query("avg_order_value", f"""
    select customer_name, total_orders, total_spent,
           {rounded("total_spent / total_orders", 2)} as avg_order_value
    from customer_orders where total_orders > 0 order by total_spent desc, customer_id""")
def _(spark, sf):
    return shown(reports.avg_order_value(models(spark, sf)["customer_orders"]))


@query("recent_orders", f"""
    select order_id, customer_name, market_segment, order_priority,
           {money("r.list_price")} as list_price, {money("r.net_revenue")} as net_revenue,
           line_count, returned_lines, order_date
    from order_revenue r join stg_customers using (customer_id)
    order by order_date desc, order_id limit 10""")
def _(spark, sf):
    m = models(spark, sf)
    return reports.recent_orders_live(m["stg_orders"], m["stg_lineitem"], m["stg_customers"])


@query("recent_orders_basic", f"""
    select order_id, customer_name, {money("order_amount")} as amount, order_date
    from stg_orders join stg_customers using (customer_id)
    order by order_date desc, order_id limit 10""")
def _(spark, sf):
    m = models(spark, sf)
    return reports.recent_orders_basic(m["stg_orders"], m["stg_customers"])


_COUNTS = " union all ".join(f"select '{t}' as tbl, count(*) as rows from {t}" for t in COUNTED)


@query("table_row_counts", _COUNTS)
def _(spark, sf):
    return reports.table_row_counts({t: scan_source(spark, sf, t) for t in COUNTED})


@query("union_all_counts", f"select cast(sum(rows) as bigint) as rows from ({_COUNTS}) c")
def _(spark, sf):
    counts = reports.table_row_counts({t: scan_source(spark, sf, t) for t in COUNTED})
    return counts.agg(F.sum("rows").alias("rows"))
