from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest
from comparison import differences
from pyspark.sql import functions as F
from support import values, write_events

from tidemart.operators import metrics
from tidemart.operators.metrics import MEMORY, MEMORY_LIMIT
from tidemart.plans.inputs import LAKE_GAUGES, RANGE
from tidemart.plans.registry import load_entries
from tidemart.schemas import SAMPLE_DDL

START = dt.datetime(2024, 1, 1)


def samples(spark, *rows):
    """Rows (metric, labels, seconds, value)."""
    return spark.createDataFrame(
        [(m, labels, START + dt.timedelta(seconds=s), v) for m, labels, s, v in rows], SAMPLE_DDL
    )


def brute_force(rows, window):
    """Rate of every sample, straight from the definition."""
    series = {}
    for metric, labels, second, value in rows:
        series.setdefault((metric, tuple(sorted(labels.items()))), []).append((second, value))
    out = {}
    for key, points in series.items():
        points.sort()
        for at, _ in points:
            inside = [(s, v) for s, v in points if at - window < s <= at]
            steps = [b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:])]
            span = inside[-1][0] - inside[0][0]
            out[key, at] = sum(steps) / span if span else None
    return out


def rates(df):
    return {
        ((r.metric, tuple(sorted(r.labels.items()))), (r.ts - START).total_seconds()): r.rate
        for r in df.collect()
    }


@pytest.mark.parametrize("chunk_s", [None, 120, 137, 100_000])
def test_rates_equal_the_definition_for_any_chunk(spark, chunk_s):
    rng = random.Random(5)
    rows = []
    for name, share in (("hot", 600), ("warm", 60), ("cold", 3)):
        for second in rng.sample(range(20_000), share):
            rows.append(("m", {"name": name, "z": "1"}, second, float(rng.randrange(100))))
    got = rates(metrics.counter_rate(samples(spark, *rows), 120, chunk_s))
    want = brute_force(rows, 120)
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert (got[key] is None) == (value is None)
        assert value is None or got[key] == pytest.approx(value, abs=1e-9)


@pytest.mark.parametrize("chunk_rows", [1, 7, 100, 10_000])
def test_rates_equal_the_definition_for_chunks_by_rows(spark, chunk_rows):
    rng = random.Random(6)
    rows = [("m", {"name": "c"}, s, float(rng.randrange(50))) for s in sorted(rng.sample(range(900), 700))]
    rows += [("m", {"name": "c"}, s, float(rng.randrange(50))) for s in range(3000, 30_000, 500)]
    rows += [("m", {"name": "d"}, s, float(rng.randrange(50))) for s in range(0, 8000, 40)]
    got = rates(metrics.counter_rate(samples(spark, *rows), 120, chunk_rows=chunk_rows))
    want = brute_force(rows, 120)
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert (got[key] is None) == (value is None)
        assert value is None or got[key] == pytest.approx(value, abs=1e-9)


def test_a_million_samples_in_an_hour_are_spread(spark):
    """One series, denser at its end: equal to the uncut result, and no chunk with more than a few windows' samples."""
    n = 1_000_000
    us = (F.col("id") * 3600 - F.pmod(F.col("id"), F.lit(7)) * 100).cast("long")
    dense = spark.range(n).select(
        F.lit("m").alias("metric"), F.create_map(F.lit("name"), F.lit("hot")).alias("labels"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + us).alias("ts"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("value"))
    cut = metrics.counter_rate(dense, 120, chunk_rows=20_000)
    whole = metrics.counter_rate(dense, 120, chunk_s=100_000)
    both = cut.select("ts", F.col("rate").alias("a")).join(whole.select("ts", F.col("rate").alias("b")), "ts")
    found = both.agg(F.count("*"), F.max(F.abs(F.col("a") - F.col("b"))), F.count_if(F.col("a").isNull() != F.col("b").isNull())).first()
    assert found[0] == n and found[1] < 1e-6 and found[2] == 0
    known = dense.withColumns({"_series": metrics.series_id(), "_us": F.unix_micros("ts")})
    sizes = metrics._by_rows(known, 120 * metrics.SECOND, 20_000).groupBy("_own").count()
    assert sizes.agg(F.max("count")).first()[0] <= 35_000 and sizes.count() >= 28


def test_rate_cases(spark):
    labels = {"name": "c"}
    rows = [("m", labels, s, v) for s, v in
            ((0, 10.0), (60, 70.0), (119, 129.0), (120, 5.0), (1000, 6.0), (1060, 6.0))]
    got = {at: rate for (_, at), rate in rates(metrics.counter_rate(samples(spark, *rows))).items()}
    assert got[0] is None and got[1000] is None
    assert got[60] == 1.0
    assert got[119] == 1.0
    assert got[120] == pytest.approx((59 + 5) / 60)  # 0 has left the window; 5 after a reset
    assert got[1060] == 0.0


def test_series_do_not_mix_and_label_order_is_irrelevant(spark):
    rows = [("m", {"a": "1", "b": "2"}, 0, 0.0), ("m", {"b": "2", "a": "1"}, 10, 5.0),
            ("m", {"a": "2", "b": "2"}, 10, 50.0), ("n", {"a": "1", "b": "2"}, 10, 50.0)]
    got = [r for r in rates(metrics.counter_rate(samples(spark, *rows))).values() if r is not None]
    assert got == [0.5]


def test_a_series_is_spread_over_chunks(spark):
    rows = [("m", {"name": "hot"}, s, float(s)) for s in range(0, 36_000, 30)]
    df = metrics.counter_rate(samples(spark, *rows), 120)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(metric" in text and "_chunk" in text
    assert text.count("Exchange") == 1 and df.count() == len(rows)


def test_cpu_and_io(spark):
    cpu = [(metrics.CPU, {"name": n, "instance": i}, s, s * k)
           for n, i, k in (("c", "1", 0.5), ("c", "2", 0.25), ("", "3", 9.0)) for s in (0, 60)]
    got = metrics.cpu_percent(samples(spark, *cpu)).where("value is not null")
    assert values(got, "name", "value") == [("c", 75.0)]
    io = [(m, {"name": "c"}, s, s * k)
          for m, k in ((metrics.NETWORK["rx"], 1.0), (metrics.NETWORK["tx"], 2.0),
                       (metrics.DISK["read"], 3.0)) for s in (0, 60)]
    assert values(metrics.network_rates(samples(spark, *io)).where("rate is not null"),
                  "direction", "rate") == [("rx", 1.0), ("tx", 2.0)]
    assert values(metrics.disk_rates(samples(spark, *io)).where("rate is not null"),
                  "direction", "rate") == [("read", 3.0)]


def test_memory_panels(spark):
    rows = [(MEMORY, {"name": "a"}, 0, 50.0), (MEMORY_LIMIT, {"name": "a"}, 0, 200.0),
            (MEMORY, {"name": "a"}, 60, 60.0), (MEMORY_LIMIT, {"name": "a"}, 60, 0.0),
            (MEMORY, {"name": "b"}, 0, 80.0), (MEMORY, {"name": ""}, 0, 80.0)]
    df = samples(spark, *rows)
    assert values(metrics.memory_ratio(df), "name", "value") == [("a", 0.25)]
    by_name = metrics.memory_by_name(df)
    assert values(by_name, "name", "value") == [("a", 50.0), ("a", 60.0), ("b", 80.0)]
    assert [tuple(r) for r in metrics.rank_current(by_name).collect()] == [("b", 80.0),
                                                                           ("a", 60.0)]
    assert metrics.rank_current(by_name, 1).count() == 1


def test_last_values(spark):
    df = samples(spark, ("m", {}, 0, 9.0), ("m", {}, 10, 3.0), ("m", {}, 20, None))
    assert values(metrics.last_not_null(df, "metric")) == [("m", 3.0)]
    assert values(metrics.last_max(df, "metric")) == [("m", None, 9.0)]


def test_growth_carries_the_last_value_forward(spark):
    rows = [("g", {}, 5, 1.0), ("g", {}, 8, 2.0), ("g", {}, 31, 5.0), ("g", {}, 500, 9.0),
            ("other", {}, 5, 1.0)]
    df = metrics.growth(samples(spark, *rows), ["g"], 10, "2024-01-01 00:00:00",
                        "2024-01-01 00:00:55")
    got = [((r.ts - START).total_seconds(), r.value) for r in df.orderBy("ts").collect()]
    assert got == [(0, 2.0), (10, 2.0), (20, 2.0), (30, 5.0), (40, 5.0), (50, 5.0)]


@pytest.mark.parametrize("stale_s, want", [
    (10, [(0, 2.0), (30, 5.0)]), (11, [(0, 2.0), (10, 2.0), (30, 5.0), (40, 5.0)]),
    (20, [(0, 2.0), (10, 2.0), (30, 5.0), (40, 5.0)]), (500, [(s, 2.0 if s < 30 else 5.0) for s in range(0, 60, 10)])])
def test_a_metric_that_stops_leaves_a_gap(spark, stale_s, want):
    rows = [("g", {}, 5, 1.0), ("g", {}, 8, 2.0), ("g", {}, 31, 5.0)]
    df = metrics.growth(samples(spark, *rows), ["g"], 10, "2024-01-01 00:00:00", "2024-01-01 00:00:55", stale_s)
    assert [((r.ts - START).total_seconds(), r.value) for r in df.orderBy("ts").collect()] == want


@pytest.mark.parametrize("key, gauges", [("lake_growth", ("lake_snapshots", "lake_data_files")),
                                         ("storage_growth", ("lake_storage_bytes",))])
def test_growth_queries_carry_gauges_to_the_end(spark, tmp_path, key, gauges):
    """A gauge that stops after one reading has a row for every step of the panel that is left."""
    start, end = map(dt.datetime.fromisoformat, RANGE)
    write_events(spark, tmp_path, *[(125, LAKE_GAUGES.index(name), "view", 2.5 + i, 1) for i, name in enumerate(gauges)],
                 (125, LAKE_GAUGES.index("lake_tables"), "view", 9.0, 1))
    entry = load_entries()[key]
    got = entry.run(spark, str(tmp_path))
    first, step = start + dt.timedelta(minutes=120), dt.timedelta(minutes=30)
    steps = [first + k * step for k in range((end - first) // step + 1)]
    assert values(got, "metric", "ts", "value") == sorted(
        [(name, at, 2.5 + i) for i, name in enumerate(gauges) for at in steps], key=repr)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert differences(got, con, entry.sql) == []


def test_current_gauges(spark):
    rows = [("lake_snapshot_age_seconds", {}, 0, 10.0), ("lake_snapshot_age_seconds", {}, 9, 400.0),
            ("lake_tables", {}, 0, 3.0), ("lake_data_files", {}, 0, 3.0)]
    assert values(metrics.current(samples(spark, *rows))) == [
        ("lake_snapshot_age_seconds", 400.0, "yellow"), ("lake_tables", 3.0, "purple")
    ]
    per_table = [("lake_table_records", {"schema": "s", "table": "t"}, i, float(i))
                 for i in range(3)]
    assert values(metrics.current_by_table(samples(spark, *per_table))) == [
        ("lake_table_records", "s.t", 2.0)
    ]


def test_two_instances_of_one_name_are_divided_apart(spark):
    rows = [(m, {"name": "a", "instance": i}, 0, v) for m, i, v in (
        (MEMORY, "1", 10.0), (MEMORY_LIMIT, "1", 100.0), (MEMORY, "2", 5.0), (MEMORY_LIMIT, "2", 10.0))]
    df = samples(spark, *rows)
    assert sorted(r["value"] for r in metrics.memory_ratio(df).collect()) == [0.1, 0.5]
    assert [r["value"] for r in metrics.series_ratio_join(df, MEMORY, MEMORY_LIMIT, by=("name",)).collect()] == [0.1]


def test_a_null_sample_does_not_break_a_rate(spark):
    df = samples(spark, *[("c", {"name": "a"}, s, v) for s, v in ((0, 0.0), (30, None), (60, 60.0))])
    assert [r["rate"] for r in metrics.counter_rate(df).orderBy("ts").collect()] == [None, 1.0]
