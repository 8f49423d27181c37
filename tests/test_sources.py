from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from support import operators, plan, values

from tidemart.operators.quality import ModelTests, dq_suite, null_counts
from tidemart.operators.reports import raw_orders
from tidemart.plans.models import build_models, run_daily
from tidemart.schemas import FACT_DDL, SEED_CUSTOMERS, SEED_ORDERS
from tidemart.sources import facts, partition_index, tables
from tidemart.sources.jdbc import jdbc_options
from tidemart.sources.partition_index import Dates

SEEDS = Path(__file__).parent / "seeds"
LOADED = ("customer", "orders", "lineitem", "nation")


def fact(spark, n=2000):
    """A fact in which one date and one artist hold most rows."""
    ids = F.col("id")
    return spark.range(n).select(
        F.when(ids % 4 == 0, F.expr("date_add(date'2024-01-01', cast(id % 5 as int))"))
        .otherwise(F.lit("2024-01-03").cast("date")).alias("event_date"),
        F.when(ids % 3 == 0, "7").otherwise((ids % 40).cast("string")).alias("artist_id"),
        ids.cast("string").alias("track_id"),
        ids.alias("streams"),
        F.lit(None).cast("decimal(38,9)").alias("revenue"),
        F.lit("s").alias("source"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("updated_at"),
    )


def test_raw_load_completes_a_partial_load(spark, sf, name):
    assert values(tables.load_raw(spark, sf, name, LOADED[:2]), "table", "skipped") == [
        ("customer", False), ("orders", False)
    ]
    second = values(tables.load_raw(spark, sf, name, LOADED))
    assert [(t, skipped) for t, _, skipped in second] == [
        ("customer", True), ("lineitem", False), ("nation", False), ("orders", True)
    ]
    assert dict((t, n) for t, n, _ in second)["nation"] == 25


def test_bucketed_raw_tables_join_without_a_shuffle(spark, sf, name):
    buckets = {"orders": ("o_orderkey", 4), "lineitem": ("l_orderkey", 4)}
    tables.load_raw(spark, sf, name, ("orders", "lineitem"), buckets)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = build_models(spark, name)["order_revenue"]
        assert operators(mart, "Exchange") == 0
        assert mart.count() == spark.table(f"{name}.orders").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_seeds_are_typed(spark, name):
    orders = tables.load_seed(spark, str(SEEDS / "raw_orders.csv"), SEED_ORDERS,
                              f"{name}.raw_orders")
    assert orders.dtypes[3] == ("order_amount", "decimal(18,2)")
    people = tables.load_seed(spark, str(SEEDS / "raw_customers.csv"), SEED_CUSTOMERS,
                              f"{name}.raw_customers")
    assert values(people) == sorted([
        (71, "Quill, Mira", "mira@example.org", dt.date(2031, 11, 30)),
        (64, "Tomasz", None, dt.date(1999, 6, 5)),
    ], key=repr)
    shown = raw_orders(tables.scan_seed(spark, f"{name}.raw_orders")).collect()
    assert [(r.order_id, r.amount) for r in shown] == [
        (902, "$18.25"), (908, "$0.07"), (915, "$4310.00"), (933, "$77.77")]
    assert orders.agg(F.sum("order_amount")).first()[0] == Decimal("4406.09")


def test_a_malformed_seed_stops_the_load(spark, name, tmp_path):
    (tmp_path / "bad.csv").write_text("order_id,customer_id,order_date,order_amount\n1,x,y,z\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        tables.load_seed(spark, str(tmp_path / "bad.csv"), SEED_ORDERS, f"{name}.bad")


def test_materialize_replaces_and_leaves_views(spark, name):
    table = f"{name}.numbers"
    tables.materialize(spark.range(3), table)
    spark.sql(f"CREATE TEMPORARY VIEW v_{name} AS SELECT max(id) AS top FROM {table}")
    tables.materialize(spark.range(5), table, bucket_by=("id", 2))
    assert spark.table(f"v_{name}").first()[0] == 4
    tables.drop_table(spark, table)
    tables.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_view_is_lazy_and_adhoc_sql_sees_models(spark, sf):
    models = build_models(spark, sf)
    assert tables.as_view(models["stg_orders"], "some_view").count() == 1500
    tables.register_models(models)
    got = tables.sql(spark, "SELECT count(*) FROM customer_orders WHERE total_orders > 2")
    assert got.first()[0] > 0
    assert tables.preview(models["customer_orders"], 3).count() == 3


def test_daily_run_passes_its_tests_and_can_be_repeated(spark, sf, name, tmp_path):
    args = dict(raw=f"{name}_raw", marts=f"{name}_marts", location=str(tmp_path),
                tables=LOADED)
    assert run_daily(spark, sf, **args).where(~F.col("passed")).count() == 0
    assert run_daily(spark, sf, **args).count() == 15
    assert spark.table(f"{name}_marts.customer_orders").count() == 150
    assert "_loaded_at" in spark.table("stg_orders").columns


def test_a_load_that_stopped_is_done_again(spark, sf, name, tmp_path):
    """Files of a table that was never registered, whole or half, are replaced."""
    raw = f"{name}_raw"
    tables.create_database(spark, raw, str(tmp_path))
    whole = tables.scan_source(spark, sf, "customer")
    whole.limit(7).write.parquet(f"{tmp_path}/{raw}/customer")
    os.makedirs(f"{tmp_path}/{raw}/nation/_temporary/0")
    report = tables.load_raw(spark, sf, raw, ("customer", "nation"), location=str(tmp_path))
    assert values(report, "table", "rows", "skipped") == [("customer", 150, False), ("nation", 25, False)]
    assert spark.table(f"{raw}.customer").count() == 150
    again = tables.load_raw(spark, sf, raw, ("customer", "nation"), location=str(tmp_path))
    assert values(again, "skipped") == [(True,), (True,)]


def test_nulls_are_counted_while_a_mart_is_written(spark, name, tmp_path):
    rows = spark.createDataFrame([(1, None), (None, None), (2, "x")], "order_id bigint, customer_id string")
    tests = {"m": ModelTests(("order_id", "customer_id"), "order_id")}
    saved, measured = tables.materialize(rows, f"{name}.m", str(tmp_path), measure=null_counts(tests["m"]))
    assert measured == {"order_id": 1, "customer_id": 2}
    suite = dq_suite({"m": saved}, tests, {"m": measured})
    assert values(suite) == values(dq_suite({"m": saved}, tests))
    # Only the key is read again.
    assert "ReadSchema: struct<order_id:bigint>" in plan(suite)


def test_jdbc_options():
    plain = jdbc_options("jdbc:postgresql://host/db", "dag_run", user="u")
    assert plain == {"url": "jdbc:postgresql://host/db", "dbtable": "dag_run",
                     "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "files", "data_file_id", 0, 1000, 16)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"]) == ("data_file_id", "0", "1000", "16")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "files", partition_column="data_file_id")


def test_a_hot_date_is_written_by_several_tasks_in_cluster_order(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts.write_fact(fact(spark), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = glob.glob(f"{path}/event_date=2024-01-03/*.parquet")
    assert len(hot) > 2
    for file in hot:
        artists = [r.artist_id for r in spark.read.parquet(file).collect()]
        assert artists == sorted(artists)
    assert facts.read_fact(spark, path, "2024-01-01", "2024-12-31").count() == 2000


def test_fact_reader_needs_a_range_and_prunes(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts.write_fact(fact(spark), path)
    with pytest.raises(ValueError):
        facts.read_fact(spark, path, None, "2024-01-02")
    some = facts.read_fact(spark, path, "2024-01-01", "2024-01-02")
    assert some.count() == fact(spark).where("event_date <= '2024-01-02'").count()
    assert {file.split("/")[-2] for file in some.inputFiles()} == {"event_date=2024-01-01", "event_date=2024-01-02"}
    assert facts.read_fact(spark, path, "2030-01-01", "2030-01-02").count() == 0
    assert facts.fact_view(spark, path, "some_days", "2024-01-02", "2024-01-02").count() == \
        fact(spark).where("event_date = '2024-01-02'").count()


def test_other_dates_are_not_listed(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts.write_fact(fact(spark), path)
    os.makedirs(f"{path}/event_date=no-date")
    os.link(glob.glob(f"{path}/event_date=2024-01-03/*.parquet")[0], f"{path}/event_date=no-date/x.parquet")
    with pytest.raises(Exception, match="no-date"):
        facts.read_all(spark, path).count()
    assert facts.read_fact(spark, path, "2024-01-01", "2024-01-02").count() > 0
    # Writes of single dates go on too.
    facts.write_fact(fact(spark).where("event_date = '2024-01-02'"), path, only_touched=True)
    assert facts.append_new(fact(spark), path).days == set()


def test_index_follows_every_write(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts.create_fact(spark, path)
    assert partition_index.read(spark, path) == Dates()
    days = [dt.date(1960, 2, 29), dt.date(2024, 1, 1), dt.date(2059, 9, 19), dt.date(2059, 9, 20), dt.date(2101, 5, 5)]
    row = spark.createDataFrame([(day, "x") for day in [*days, None]], "event_date date, artist_id string")
    for n in range(len(days) + 1):
        some = row.where(row.event_date.isin(days[:n]))
        facts.write_fact(some, path, cluster=["artist_id"], only_touched=n % 2 == 0, mode="append" if n % 2 else "overwrite")
        assert partition_index.read(spark, path) == Dates(frozenset(days[:n]))
    facts.write_fact(row.where("event_date is null"), path, cluster=["artist_id"], mode="append")
    assert partition_index.read(spark, path) == Dates(frozenset(days), True)
    assert partition_index.rebuild(spark, path) == Dates(frozenset(days), True)
    facts.write_fact(row.limit(0), path, cluster=["artist_id"])
    assert partition_index.read(spark, path) == Dates()


def test_index_is_not_trusted_after_a_failed_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    rows = fact(spark)
    facts.write_fact(rows.where("event_date <= '2024-01-02'"), path)

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(partition_index, "replace", fail)
        with pytest.raises(RuntimeError):
            facts.write_fact(rows.where("event_date = '2024-01-03'"), path, mode="append")
    assert partition_index.read(spark, path) is None
    assert facts.read_fact(spark, path, "2024-01-03", "2024-01-03").count() == rows.where("event_date = '2024-01-03'").count()
    assert facts.append_new(rows, path).days.isdisjoint({dt.date(2024, 1, 3)})
    assert dt.date(2024, 1, 3) in partition_index.read(spark, path).days


def test_append_takes_only_newer_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = fact(spark)
    facts.write_fact(rows.where("event_date <= '2024-01-02'"), path)
    old = set(glob.glob(f"{path}/event_date=*/*.parquet"))
    facts.append_new(rows, path, since="2024-01-02")
    assert old < set(glob.glob(f"{path}/event_date=*/*.parquet"))
    assert facts.read_fact(spark, path, "2024-01-01", "2024-12-31").count() == 2000
    assert all(os.path.exists(file) for file in old)


def test_append_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = fact(spark)
    for _ in range(2):  # the first call makes the table
        facts.append_new(rows, path)
        assert facts.read_all(spark, path).count() == 2000


def test_append_finds_later_rows_of_the_last_day(spark, tmp_path):
    path = str(tmp_path / "fact")

    def load(*rows, **options):
        made = spark.createDataFrame([(d and dt.date(2024, 1, d), a, "t", n, None, "s", None) for d, a, n in rows], FACT_DDL)
        facts.append_new(made, path, **options)
        return sorted(((r.event_date and r.event_date.day, r.artist_id, r.streams) for r in facts.read_all(spark, path).collect()),
                      key=repr)

    first = [(1, "x", 1), (2, "x", 1), (2, "x", 1), (None, "x", 1)]
    assert load(*first) == sorted(first, key=repr)
    # Equal rows are told apart by their number; earlier days are closed.
    more = [*first, (2, "x", 1), (2, "y", 1), (None, "y", 1), (1, "late", 1)]
    assert load(*more) == sorted(more[:-1], key=repr)
    assert load(*more) == sorted(more[:-1], key=repr)
    assert load(*more, lookback_days=1) == sorted(more, key=repr)
    # By columns: a changed measure is not a new row.
    assert load((2, "y", 5), (2, "z", 1), match=["event_date", "artist_id"]) == sorted([*more, (2, "z", 1)], key=repr)
