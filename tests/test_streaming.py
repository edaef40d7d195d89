"""Stream = batch: each streaming form, run to completion over the events
split into ordered files, equals its bounded form (SURVEY §5)."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streamweave.operators import folds, state, windows
from streamweave.operators.aggregates import word_count
from streamweave.plans.hot_items import hot_items
from streamweave.sources import testdata as td
from streamweave.streaming import forms, processors as P
from streamweave.streaming.runner import IdempotentParquetSink, run_available_now, use_rocksdb_state

SENTINEL_USER = -1


@pytest.fixture(scope="module")
def event_files(sf_dir, tmp_path_factory):
    """events split in 4 ordered files, plus a far-future sentinel row that
    closes every window and fires every timer."""
    d = tmp_path_factory.mktemp("events_stream")
    t = pq.read_table(f"{sf_dir}/events.parquet").sort_by("event_id")
    n = t.num_rows
    for i in range(4):
        pq.write_table(t.slice(i * n // 4, (i + 1) * n // 4 - i * n // 4), d / f"part{i}.parquet")
    sentinel = pa.table({"event_id": pa.array([10 ** 9], pa.int64()),
                         "ts": pa.array([dt.datetime(2030, 1, 1)], t.schema.field("ts").type),
                         "user_id": pa.array([SENTINEL_USER], pa.int64()), "event_type": ["view"],
                         "value": [1.0], "props": ['{"k": -1}']}).cast(t.schema)
    pq.write_table(sentinel, d / "part9.parquet")
    ordered_mtimes(d)
    return str(d)


def ordered_mtimes(d):
    """A file stream reads files in modification-time order: make it the
    name order, 10 s apart."""
    for i, f in enumerate(sorted(os.listdir(d))):
        os.utime(d / f, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))


def stream(spark, path):
    return forms.events_stream(spark, path, max_files_per_trigger=1)


def run(df, tmp, mode="append"):
    sink = IdempotentParquetSink(str(tmp / "out"))
    run_available_now(df, sink, str(tmp / "ckpt"), output_mode=mode)
    return sink.read(df.sparkSession).drop("batch_id")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same(got, want):
    g, w = rows(got), rows(want)
    assert len(g) == len(w), (len(g), len(w), [x for x in g if x not in set(w)][:5], [x for x in w if x not in set(g)][:5])
    assert g == w, ([x for x in g if x not in set(w)][:5], [x for x in w if x not in set(g)][:5])


def test_hot_items_stream_equals_batch(spark, sf_dir, event_files, tmp_path):
    counts = forms.hot_items_counts_stream(td.behaviors_of(stream(spark, event_files)))
    sink = forms.hot_items_sink(str(tmp_path / "out"))
    run_available_now(counts, sink, str(tmp_path / "ckpt"))
    got = sink.read(spark).drop("batch_id").where("itemId <> -1")
    want = hot_items(td.behaviors(spark, sf_dir))
    assert rows(got) == rows(want)


def test_hot_items_run_flushes_the_open_windows(spark, sf_dir, tmp_path):
    """No sentinel row: the bounded replay returns exactly the batch rows."""
    sink = forms.hot_items_stream_run(spark, sf_dir, str(tmp_path))
    same(sink.read(spark).drop("batch_id"), hot_items(td.pageviews(spark, sf_dir)))


def test_word_count_restart(spark, sf_dir, tmp_path):
    docs = pq.read_table(f"{sf_dir}/documents.parquet").sort_by("doc_id")
    d = tmp_path / "docs"
    d.mkdir()
    half = docs.num_rows // 2
    pq.write_table(docs.slice(0, half), d / "a.parquet")
    ordered_mtimes(d)
    src = spark.readStream.schema(td.DOCUMENTS_SCHEMA).parquet(str(d))
    q = forms.word_count_stream(td.lines_of(src))
    sink = IdempotentParquetSink(str(tmp_path / "out"))
    run_available_now(q, sink, str(tmp_path / "ckpt"), output_mode="update")
    pq.write_table(docs.slice(half), d / "b.parquet")  # more input, same checkpoint: resume
    run_available_now(q, sink, str(tmp_path / "ckpt"), output_mode="update")
    got = sink.read(spark).groupBy("word").agg(F.max_by("count", "batch_id").alias("count"))
    assert rows(got) == rows(word_count(td.words(spark, sf_dir)))


def test_running_count_processor(spark, sf_dir, event_files, tmp_path):
    use_rocksdb_state(spark)
    r = td.readings_of(stream(spark, event_files))
    got = run(P.apply(r, "id", P.RunningCount("id"), P.RunningCount.schema()), tmp_path)
    want = state.count_per_key(td.readings(spark, sf_dir)).select("id", "seq", "count")
    same(got.where("id <> 'sensor_-1'"), want)


def test_jump_and_count_window_processors(spark, sf_dir, event_files, tmp_path):
    use_rocksdb_state(spark)
    r = td.readings_of(stream(spark, event_files))
    got = run(P.apply(r, "id", P.JumpAlert(10.0), P.JumpAlert.schema()), tmp_path / "j")
    assert rows(got) == rows(state.temperature_jumps(td.readings(spark, sf_dir), 10.0))
    got = run(P.apply(r, "id", P.CountWindow(10, 2), P.CountWindow.schema()), tmp_path / "c")
    want = windows.count_window(td.readings(spark, sf_dir), "id", 10, 2)
    assert rows(got.where("id <> 'sensor_-1'")) == rows(want)


def test_event_time_folds(spark, sf_dir, event_files, tmp_path):
    use_rocksdb_state(spark)
    r = forms.with_event_time(td.readings_of(stream(spark, event_files))).withWatermark("event_time", forms.ASCENDING)
    got = run(P.apply(r, "id", P.RisingAlert("1 day"), P.RisingAlert.schema(), "EventTime"), tmp_path / "r")
    want = folds.rising_alerts(td.readings(spark, sf_dir), "1 day")
    assert rows(got.where("id <> 'sensor_-1'")) == rows(want)
    lg = forms.with_event_time(td.logins_of(stream(spark, event_files)), unit="s") \
        .withWatermark("event_time", forms.ASCENDING)
    got = run(P.apply(lg, "userId", P.LoginFail("12 hours", 1), P.LoginFail.schema(), "EventTime"), tmp_path / "l")
    want = folds.login_fail_warnings(td.logins(spark, sf_dir), "12 hours", 1)
    assert rows(got) == rows(want)


def test_dedup_and_sessions(spark, sf_dir, event_files, tmp_path):
    b = td.behaviors_of(stream(spark, event_files)).where("behavior = 'pv'")
    got = run(forms.dedup_stream(b, ["itemId", "timestamp"]), tmp_path / "d")
    want = state.dedup_first(td.behaviors(spark, sf_dir).where("behavior = 'pv'"), ["itemId", "timestamp"])
    assert rows(got.where("itemId <> -1")) == rows(want)

    r = td.readings_of(stream(spark, event_files))
    got = run(forms.session_stream(r, "1 hour"), tmp_path / "s")
    want = windows.session_windows(td.readings(spark, sf_dir), "id", "1 hour")
    assert rows(got.where("id <> 'sensor_-1'").select("id", "session_start", "session_end", "count")) == rows(want)


def test_seen_filter_and_daily_visits(spark, sf_dir, event_files, tmp_path):
    use_rocksdb_state(spark)
    b = td.behaviors_of(stream(spark, event_files)).where("behavior = 'pv'")
    got = run(P.apply(b, "itemId", P.SeenFilter(retention_s=0), P.SeenFilter.schema()), tmp_path / "f")
    want = state.dedup_first(td.behaviors(spark, sf_dir).where("behavior = 'pv'"), ["itemId", "timestamp"])
    assert rows(got.where("itemId <> -1")) == rows(want.select("itemId", "timestamp", "seq"))
    a = td.behaviors_of(stream(spark, event_files))
    got = run(P.apply(a, "userId", P.FirstVisitPerDay(None), P.FirstVisitPerDay.schema(), "None"),
              tmp_path / "v")
    want = td.behaviors(spark, sf_dir).select("userId", F.expr("timestamp div 86400").alias("day")).distinct()
    assert rows(got.where("userId <> -1")) == rows(want)


def test_delay_timer(spark, tmp_path):
    use_rocksdb_state(spark)
    d = tmp_path / "in"
    d.mkdir()
    for i, (sid, t) in enumerate([("s1", 1000), ("s2", 1500), ("s1", 5000), ("s9", 10 ** 9)]):
        pq.write_table(pa.table({"id": [sid], "timestamp": pa.array([t], pa.int64())}), d / f"p{i}.parquet")
    ordered_mtimes(d)
    src = spark.readStream.schema("id string, timestamp long").option("maxFilesPerTrigger", 1).parquet(str(d))
    ev = forms.with_event_time(src).withWatermark("event_time", forms.ASCENDING)
    got = run(P.apply(ev, "id", P.DelayTimer(100), P.DelayTimer.schema(), "EventTime"), tmp_path)
    assert sorted((r.id, r.deadline) for r in got.collect()) == [("s1", 1100), ("s1", 5100), ("s2", 1600)]
    assert all(r.watermark >= r.deadline for r in got.collect())


def test_first_visit_with_ttl_state(spark, sf_dir, tmp_path):
    """ST12: value state with a TTL, processing-time mode, processing-time
    trigger (polled until the expected rows arrived, then stopped)."""
    import time

    from pyspark.sql import functions as F
    use_rocksdb_state(spark)
    d = tmp_path / "in"
    d.mkdir()
    pq.write_table(pq.read_table(f"{sf_dir}/events.parquet"), d / "p0.parquet")
    src = forms.events_stream(spark, str(d))
    q = (P.apply(td.behaviors_of(src), "userId", P.FirstVisitPerDay(86_400_000), P.FirstVisitPerDay.schema(),
                 "ProcessingTime")
         .writeStream.format("memory").queryName("sw_ttl").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="1 second").start())
    want = td.behaviors(spark, sf_dir).select("userId", F.expr("timestamp div 86400").alias("day")).distinct()
    n_want = want.count()
    try:
        deadline = time.time() + 120
        while time.time() < deadline and spark.table("sw_ttl").count() < n_want:
            time.sleep(1)
    finally:
        q.stop()
    same(spark.table("sw_ttl"), want)
