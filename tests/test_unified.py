from __future__ import annotations

import datetime as dt
import glob
import random
from decimal import Decimal

import duckdb
import pytest
from comparison import differences
from pyspark.sql import functions as F
from support import given, operators, values, write_events

from tidemart.operators import joins, unified
from tidemart.operators.quality import dq_grain
from tidemart.operators.staging import SOURCE_A, SOURCE_B, pack_extra, stg_platform
from tidemart.plans import queries_flows
from tidemart.plans.registry import load_entries
from tidemart.schemas import FACT_DDL, ContractError, check_contract, contract_report
from tidemart.sources.facts import read_fact, write_fact

NOW = dt.datetime(2024, 1, 31)


def row(day, artist, track, streams, revenue=None, source="a"):
    return {
        "event_date": dt.date(2024, 1, day), "artist_id": artist, "track_id": track,
        "streams": streams, "revenue": None if revenue is None else Decimal(revenue),
        "source": source, "updated_at": NOW,
    }


def fact(spark, *rows):
    return given(spark, FACT_DDL, *rows)


def short(df):
    return values(df.select(F.dayofmonth("event_date"), "artist_id", "track_id", "streams",
                            F.col("revenue").cast("double")))


def test_merge_updates_inserts_and_keeps(spark):
    target = fact(spark, row(1, "x", "t", 1, "1"), row(2, "x", "t", 2, "2"),
                  row(3, None, "t", 3))
    source = fact(spark, row(2, "x", "t", 20), row(2, "x", "u", 21), row(3, None, "t", 30),
                  row(3, None, "t", 30))
    assert short(unified.merge_upsert(target, source)) == sorted([
        (1, "x", "t", 1, 1.0), (2, "x", "t", 20, None), (2, "x", "u", 21, None),
        (3, None, "t", 3, None), (3, None, "t", 30, None), (3, None, "t", 30, None),
    ], key=repr)


def test_merge_refuses_a_source_with_a_repeated_key(spark):
    source = fact(spark, row(2, "x", "t", 20), row(2, "x", "t", 21))
    with pytest.raises(Exception, match="more than one row"):
        unified.merge_upsert(fact(spark, row(1, "x", "t", 1)), source).collect()


def test_merge_reads_and_shuffles_each_side_once(spark, tmp_path):
    for side in ("old", "new"):
        fact(spark, row(1, "x", "t", 1)).write.parquet(str(tmp_path / side))
    old, new = (spark.read.parquet(str(tmp_path / side)) for side in ("old", "new"))
    merged = unified.merge_upsert(old, new)
    assert operators(merged, "FileScan") == 2
    assert operators(merged, "Exchange") == 2


def test_incremental_merge_rewrites_only_the_window(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_fact(fact(spark, row(1, "x", "t", 1), row(14, "x", "t", 2), row(20, "x", "t", 3)), path)
    old_file = glob.glob(f"{path}/event_date=2024-01-01/*.parquet")
    sources = [
        fact(spark, row(1, "x", "t", 100), row(20, "x", "t", 30)),
        fact(spark, row(21, "y", "t", 5, "1.5", "b")),
    ]
    want = [(1, "x", "t", 1, None), (14, "x", "t", 2, None), (20, "x", "t", 30, None),
            (21, "y", "t", 5, 1.5)]
    for _ in range(2):  # a rerun of the same day changes nothing
        unified.apply_incremental_merge(spark, path, sources, "2024-01-21")
        assert short(read_fact(spark, path, "2024-01-01", "2024-12-31")) == want
    assert glob.glob(f"{path}/event_date=2024-01-01/*.parquet") == old_file


def test_window_bound_is_seven_days_inclusive(spark):
    target = fact(spark)
    source = fact(spark, row(13, "x", "t", 1), row(14, "x", "t", 2))
    got = unified.incremental_merge(target, [source], "2024-01-21")
    assert short(got) == [(14, "x", "t", 2, None)]


def test_sources_are_staged_to_one_contract(spark):
    a = spark.createDataFrame(
        [(NOW, 1, 2, 3, NOW)],
        "stream_date timestamp, artist_id bigint, track_id bigint, streams bigint, "
        "updated_at timestamp",
    )
    b = spark.createDataFrame(
        [(NOW, 1, 2, 3, text, NOW) for text in ("12.50", "n/a", None)],
        "report_date timestamp, channel_artist_id bigint, video_track_id bigint, views bigint, "
        "estimated_revenue string, updated_at timestamp",
    )
    both = unified.union_all_sources(
        stg_platform(a, SOURCE_A, "source_a"), stg_platform(b, SOURCE_B, "source_b")
    )
    assert values(both, "artist_id", "revenue", "source") == sorted([
        ("1", None, "source_a"), ("1", Decimal("12.500000000"), "source_b"),
        ("1", None, "source_b"), ("1", None, "source_b"),
    ], key=repr)


def test_contract_checks_order_and_types(spark):
    good = fact(spark)
    assert check_contract(good, FACT_DDL) is good
    with pytest.raises(ContractError):
        unified.union_all_sources(good, good.select(*reversed(good.columns)))
    with pytest.raises(ContractError):
        unified.union_all_sources(good, good.withColumn("revenue", F.lit(None).cast("double")))


def test_contract_report_names_every_column(spark):
    good = fact(spark, row(1, "x", "t", 1), row(2, None, "t", 1))
    report = contract_report("good", good, FACT_DDL)
    assert report.where(~F.col("ok")).count() == 0 and report.count() == 7
    assert values(report.where("column in ('artist_id', 'revenue')"), "column", "filled") == [("artist_id", 1), ("revenue", 0)]
    bad = good.drop("source").withColumn("revenue", F.lit(1.5)).withColumn("note", F.lit("n"))
    assert values(contract_report("bad", bad, FACT_DDL).where(~F.col("ok")), "column", "place", "expected", "found", "filled") == sorted([
        ("note", None, None, "string", 2), ("revenue", 5, "decimal(38,9)", "double", 2), ("source", 6, "string", None, 0),
        ("updated_at", 7, "timestamp", "timestamp", 2)], key=repr)
    moved = good.select(*reversed(good.columns))
    assert contract_report("moved", moved, FACT_DDL).where("ok").count() == 1
    assert contract_report("empty", good.limit(0).select(), "a int").first().ok is False


def test_contract_query_returns_the_whole_fact(spark, tmp_path, monkeypatch):
    """Every row of the fact under the contract, not a report on it; a broken contract is an error."""
    write_events(spark, tmp_path, (1, 7, "view", 1.5, 3), (2, 7, "view", 2.5, 3), (3, 8, "purchase", 4.25, 11),
                 (4, 8, "purchase", 1.0, 20), (5, 9, "click", 1.0, 1))
    entry = load_entries()["dq_schema_contract"]
    got = entry.run(spark, str(tmp_path))
    assert values(got, "artist_id", "track_id", "streams", "revenue", "source") == sorted([
        ("7", "3", 2, None, "source_a"), ("8", "11", 1, 4.25, "source_b"), ("8", "20", 1, None, "source_b")], key=repr)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert differences(got, con, entry.sql) == []
    whole = queries_flows.fact_rows
    monkeypatch.setattr(queries_flows, "fact_rows", lambda *a: whole(*a).withColumnRenamed("source", "note"))
    with pytest.raises(ContractError):
        entry.run(spark, str(tmp_path))


def test_dashboard_counts_distinct_tracks(spark):
    rows = fact(spark, row(1, "x", "t", 1, "1"), row(1, "x", "t", 2, "2"), row(1, "x", "u", 4),
                row(1, "x", "u", 8, source="b"))
    daily = unified.dashboard_artist_daily(rows)
    assert values(daily, "source", "streams", "revenue", "tracks") == [
        ("a", 7, Decimal("3.000000000"), 2), ("b", 8, None, 1)
    ]
    assert unified.query_dashboard(daily, "2024-01-01", "2024-01-01", "x").count() == 2
    assert unified.query_dashboard(daily, "2024-01-02", "2024-01-03", "x").count() == 0


def test_grain_violations(spark):
    rows = fact(spark, row(1, "x", "t", 1), row(1, "x", "t", 2), row(1, "x", "t", 3, source="b"))
    assert values(dq_grain(rows), "artist_id", "source", "n_rows") == [("x", "a", 2)]


def test_grains_meet_after_reduction(spark):
    daily = fact(spark, row(1, "x", "t", 1), row(2, "x", "u", 2), row(3, "y", "u", 4))
    monthly = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "x", 10.0), (dt.date(2024, 2, 1), "x", 5.0)],
        "month date, artist_id string, revenue double",
    )
    got = joins.combine_grains(daily, monthly, ["month", "artist_id"])
    assert values(got.select(F.month("month"), "artist_id", "streams", "revenue")) == [
        (1, "x", 3, 10.0), (1, "y", 4, None), (2, "x", None, 5.0)
    ]


def test_pack_extra(spark):
    df = spark.createDataFrame([(1, "a", None)], "id int, extra_a string, extra_b string")
    assert values(pack_extra(df, ["id"])) == [(1, '{"extra_a":"a"}')]
    assert values(pack_extra(df.select("id"), ["id"])) == [(1, None)]


def test_child_counts_include_zero(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert values(joins.correlated_child_count(parent, child, "k")) == [(1, 2), (2, 0)]


def test_merge_equals_a_plain_dictionary_update(spark):
    rng = random.Random(11)

    def side(n, offset):
        keys = {(rng.randrange(1, 29), f"a{rng.randrange(6)}", f"t{rng.randrange(20)}")
                for _ in range(n)}
        return {key: row(*key, offset + i) for i, key in enumerate(sorted(keys))}

    target, source = side(400, 0), side(400, 10_000)
    merged = unified.merge_upsert(fact(spark, *target.values()), fact(spark, *source.values()))
    want = {**target, **source}
    assert len(want) < len(target) + len(source)
    assert short(merged) == sorted(((*key, r["streams"], None) for key, r in want.items()),
                                   key=repr)


def test_rows_without_a_key_are_spread(spark):
    keyless = spark.range(1000).select(
        F.lit(None).cast("string").alias("k"), F.col("id").alias("v")
    )
    complete = keyless.withColumn("k", F.lit("a"))
    assert unified._spread_keyless(complete, ["k"]).select("_salt").distinct().count() == 1
    assert unified._spread_keyless(keyless, ["k"]).select("_salt").distinct().count() == 1000
    merged = unified.merge_upsert(keyless, keyless, ["k"], ["v"])
    assert merged.count() == 2000


def test_first_merge_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "new")
    unified.apply_incremental_merge(spark, path, [fact(spark, row(20, "x", "t", 3))], "2024-01-21")
    assert short(read_fact(spark, path, "2024-01-01", "2024-12-31")) == [(20, "x", "t", 3, None)]
