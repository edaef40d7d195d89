"""State handed from a bounded backfill to a stream, and state that expires in event time."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from streamweave.operators import state
from streamweave.operators.aggregates import distinct_per_bucket
from streamweave.sources import testdata as td
from streamweave.streaming import forms, processors as P
from streamweave.streaming.runner import IdempotentParquetSink, run_available_now, use_rocksdb_state
from tests.test_streaming import event_files, ordered_mtimes, run, same, stream  # noqa: F401


@pytest.fixture()
def halves(spark, sf_dir, tmp_path):
    """(events of the first half, folder with the others, which come later, in three files)."""
    t = pq.read_table(f"{sf_dir}/events.parquet").sort_by("event_id")
    n, d = t.num_rows, tmp_path / "later"
    d.mkdir()
    pq.write_table(t.slice(0, n // 2), tmp_path / "before.parquet")
    for i in range(3):
        a, b = n // 2 + i * (n - n // 2) // 3, n // 2 + (i + 1) * (n - n // 2) // 3
        pq.write_table(t.slice(a, b - a), d / f"p{i}.parquet")
    ordered_mtimes(d)
    return td.readings_of(spark.read.parquet(str(tmp_path / "before.parquet"))), str(d)


def test_backfill_and_stream_are_the_batch(spark, sf_dir, halves, tmp_path):
    use_rocksdb_state(spark)
    before, later = halves
    every = td.readings(spark, sf_dir)
    cut = before.agg(F.max("seq")).first()[0]
    got = run(P.apply(td.readings_of(stream(spark, later)), "id", P.RunningCount("id"), P.RunningCount.schema(),
                      initial=state.counts_so_far(before)), tmp_path / "c")
    same(got, state.count_per_key(every).where(F.col("seq") > cut).select("id", "seq", "count"))
    got = run(P.apply(td.readings_of(stream(spark, later)), "id", P.JumpAlert(), P.JumpAlert.schema(),
                      initial=state.last_readings(before)), tmp_path / "j")
    same(got.select("id", "lastTemp", "temperature", "seq"), state.temperature_jumps(every).where(F.col("seq") > cut))


def test_a_restart_does_not_load_the_initial_state_again(spark, sf_dir, halves, tmp_path):
    use_rocksdb_state(spark)
    before, later = halves
    sink, moved = IdempotentParquetSink(str(tmp_path / "out")), tmp_path / "in"
    moved.mkdir()
    query = lambda: P.apply(td.readings_of(stream(spark, str(moved))), "id", P.RunningCount("id"), P.RunningCount.schema(),
                            initial=state.counts_so_far(before))
    for i in range(3):
        pq.write_table(pq.read_table(f"{later}/p{i}.parquet"), moved / f"p{i}.parquet")
        ordered_mtimes(moved)
        run_available_now(query(), sink, str(tmp_path / "ck"))
    cut = before.agg(F.max("seq")).first()[0]
    want = state.count_per_key(td.readings(spark, sf_dir)).where(F.col("seq") > cut).select("id", "seq", "count")
    same(sink.read(spark).drop("batch_id"), want)


def test_daily_visits_expire_in_event_time(spark, sf_dir, event_files, tmp_path):  # noqa: F811
    use_rocksdb_state(spark)
    visits = forms.with_event_time(td.behaviors_of(stream(spark, event_files)), unit="s").withWatermark("event_time", "1 hour")
    got = run(P.apply(visits, "userId", P.DailyVisit(), P.DailyVisit.schema(), "EventTime"), tmp_path)
    got = got.where("userId <> -1")
    want = td.behaviors(spark, sf_dir).select("userId", F.expr("timestamp div 86400").alias("day")).distinct()
    same(got, want)
    users = got.groupBy((F.col("day") * 86_400).alias("bucket_start")).agg(F.count("*").alias("users"))
    same(users, distinct_per_bucket(td.behaviors(spark, sf_dir)))
    # The last row lies years later: nothing but its own day is left in the store.
    left = (spark.read.format("statestore").option("stateVarName", "days").load(str(tmp_path / "ckpt")))
    assert [r.key.userId for r in left.select("key").collect()] == [-1]


def test_visits_out_of_order_within_the_delay(spark, tmp_path):
    from tests.test_streaming_more import one_row_files
    use_rocksdb_state(spark)
    d = tmp_path / "in"
    rows = [(1, 86_399), (1, 86_401), (1, 86_390), (2, 86_380), (1, 90_000), (1, 200_000), (2, 300_000), (9, 10 ** 9)]
    src = one_row_files(spark, d, rows, "userId long, timestamp long")
    ev = forms.with_event_time(src, unit="s").withWatermark("event_time", "10 minutes")
    got = run(P.apply(ev, "userId", P.DailyVisit(), P.DailyVisit.schema(), "EventTime"), tmp_path)
    assert sorted(tuple(r) for r in got.where("userId <> 9").collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 3)]
