from __future__ import annotations

import datetime as dt
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import values

from tidemart.operators.runs import runs_per_hour
from tidemart.sources.facts import create_fact, read_fact
from tidemart.streaming import streams

RECORDS = ("ts timestamp, artist_id string, track_id string, source string, streams bigint, "
           "revenue decimal(18,2)")
RUNS = "execution_date timestamp, state string"
EVER = ("2000-01-01", "2100-01-01")


def day(n, hour=0):
    return dt.datetime(2024, 1, n, hour)


def feed(spark, folder, schema, *batches):
    """A file per batch, read one at a time in order of their age."""
    os.makedirs(folder)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}-{i}")
        part = next(f for f in os.listdir(f"{folder}-{i}") if f.endswith(".parquet"))
        os.link(f"{folder}-{i}/{part}", f"{folder}/{i:03d}.parquet")
        os.utime(f"{folder}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows_of(spark, path):
    return values(read_fact(spark, path, *EVER).select(
        F.dayofmonth("event_date"), "artist_id", "track_id", "source", "streams",
        F.col("revenue").cast("double"),
    ))


def test_upsert_follows_the_stream_and_drops_what_is_too_late(spark, tmp_path):
    stream = feed(
        spark, str(tmp_path / "in"), RECORDS,
        [(day(1), "x", "t", "a", 1, None), (day(2), "x", "t", "a", 2, None)],
        # The same key again, a NULL key, and a jump that moves the watermark to the 13th.
        [(day(2, 5), "x", "t", "a", 3, None), (day(2), None, "t", "a", 1, None),
         (day(20), "x", "t", "b", 1, Decimal(5))],
        [(day(21), "y", "t", "b", 1, Decimal(7))],
        # Later than seven days behind, and one that is just in time.
        [(day(3), "late", "t", "a", 9, None), (day(15), "z", "t", "a", 9, None)],
    )
    path = str(tmp_path / "fact")
    job = streams.stream_upsert(stream, path, str(tmp_path / "progress"), availableNow=True)
    job.awaitTermination()
    assert rows_of(spark, path) == sorted([
        (1, "x", "t", "a", 1, None), (2, "x", "t", "a", 5, None), (2, None, "t", "a", 1, None),
        (20, "x", "t", "b", 1, 5.0), (21, "y", "t", "b", 1, 7.0), (15, "z", "t", "a", 9, None),
    ], key=repr)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    create_fact(spark, path)
    batch = spark.createDataFrame(
        [(day(1).date(), "x", "t", 1, None, "a", day(1)),
         (day(1).date(), None, "t", 2, None, "a", day(1))],
        "event_date date, artist_id string, track_id string, streams bigint, "
        "revenue decimal(38,9), source string, updated_at timestamp",
    )
    upsert = streams.upsert_batch(spark, path)
    upsert(batch, 0)
    once = rows_of(spark, path)
    upsert(batch, 0)
    upsert(batch.limit(0), 1)
    assert rows_of(spark, path) == once and len(once) == 2
    create_fact(spark, path)
    assert len(rows_of(spark, path)) == 2


BATCH = ("event_date date, artist_id string, track_id string, streams bigint, "
         "revenue decimal(38,9), source string, updated_at timestamp")


def batch_of(spark, *rows):
    return spark.createDataFrame([(day(d).date(), "x", t, n, None, "a", day(1)) for d, t, n in rows], BATCH)


def streams_of(spark, path):
    return sorted((r.event_date.day, r.track_id, r.streams) for r in read_fact(spark, path, *EVER).collect())


def test_a_finished_batch_is_skipped_and_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    create_fact(spark, path)
    upsert = streams.upsert_batch(spark, path)
    upsert(batch_of(spark, (1, "t", 1)), 0)
    upsert(batch_of(spark, (1, "t", 2)), 1)
    for old in (0, 1):
        upsert(batch_of(spark, (1, "t", 9)), old)
    assert streams_of(spark, path) == [(1, "t", 2)]
    folder = spark.conf.get("spark.checkpoint.dir")
    assert not [name for name in os.listdir(folder) if name.startswith("upsert-")]
    # Another stream has a record of its own.
    streams.upsert_batch(spark, path, stream="other")(batch_of(spark, (1, "u", 5)), 0)
    assert streams_of(spark, path) == [(1, "t", 2), (1, "u", 5)]


def test_a_batch_stopped_while_it_is_written_goes_on(spark, tmp_path, monkeypatch):
    """The write had removed a date when it stopped; the staged rows bring it back."""
    path = str(tmp_path / "fact")
    create_fact(spark, path)
    upsert = streams.upsert_batch(spark, path)
    upsert(batch_of(spark, (1, "t", 1), (2, "t", 1)), 0)
    batch = batch_of(spark, (2, "u", 2), (3, "u", 2))

    def stop(*_, **__):
        shutil.rmtree(f"{path}/event_date=2024-01-02")
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(streams, "write_fact", stop)
        with pytest.raises(RuntimeError):
            upsert(batch, 1)
    streams.upsert_batch(spark, path)(batch, 1)
    assert streams_of(spark, path) == [(1, "t", 1), (2, "t", 1), (2, "u", 2), (3, "u", 2)]


def test_a_batch_stopped_before_it_is_recorded_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    create_fact(spark, path)
    batch = batch_of(spark, (2, "u", 2))
    plain = streams._record

    def stop(session, folder, batch_id, state):
        if state == "done":
            raise RuntimeError("stopped")
        plain(session, folder, batch_id, state)

    with monkeypatch.context() as patch:
        patch.setattr(streams, "_record", stop)
        with pytest.raises(RuntimeError):
            streams.upsert_batch(spark, path)(batch, 0)
    for _ in range(2):
        streams.upsert_batch(spark, path)(batch, 0)
        assert streams_of(spark, path) == [(2, "u", 2)]


def test_hours_equal_the_batch_report(spark, tmp_path):
    states = ("success", "failed", "running", "queued")
    runs = [(day(1, i % 20), states[i % 4]) for i in range(80)]
    stream = feed(spark, str(tmp_path / "in"), RUNS, runs[:40], runs[40:], [(day(3), "queued")])
    out = str(tmp_path / "out")
    job = streams.stream_to_table(
        streams.stream_runs_per_hour(stream, "12 hours"), out, str(tmp_path / "progress"),
        availableNow=True,
    )
    job.awaitTermination()
    batch = runs_per_hour(spark.createDataFrame(runs, RUNS), day(1), day(2))
    assert values(spark.read.parquet(out)) == values(batch)


def test_metric_windows(spark, tmp_path):
    schema = "metric string, labels map<string,string>, ts timestamp, value double"
    at = [day(1) + dt.timedelta(seconds=s) for s in (0, 60, 150, 3600)]
    rows = [("m", {"name": "c"}, ts, float(i + 1)) for i, ts in enumerate(at)]
    stream = feed(spark, str(tmp_path / "in"), schema, rows)
    out = str(tmp_path / "out")
    job = streams.stream_to_table(
        streams.stream_metric_windows(stream), out, str(tmp_path / "progress"), availableNow=True
    )
    job.awaitTermination()
    got = spark.read.parquet(out)
    first = got.where(F.col("window_start") == F.lit(day(1))).first()
    assert (first["sum"], first["max"], first["last"]) == (3.0, 2.0, 2.0)
    assert got.where(F.col("window_start") == F.lit(at[1])).first()["sum"] == 5.0


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    from types import SimpleNamespace

    from tidemart.session import shared_folder

    conf = SimpleNamespace(get=lambda key, default: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster)
    conf.get = lambda key, default: "hdfs:///shared/"
    assert shared_folder(cluster) == "hdfs:///shared"


def test_state_is_kept_on_disk(spark):
    session = streams.stream_session(spark, 3)
    assert session.conf.get("spark.sql.streaming.stateStore.providerClass") == streams.STATE_STORE
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
