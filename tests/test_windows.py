from pyspark.sql import functions as F

from streamweave.operators import windows as W
from streamweave.plans import hot_items as H
from streamweave.sources import testdata as td
from tests.fixtures import BEHAVIOR_BASE, BEHAVIOR_RUN2, T0, behavior_df, sensor_df

EXPECTED_RUN1 = {3: [11, 22], 5: [11, 22, 33, 44], 7: [22, 33, 44, 55, 66], 9: [44, 55, 66, 88, 99],
                 11: [66, 88, 99], 13: [99]}


def hot(df, fn=H.hot_items):
    out = fn(df, size="5 seconds", slide="2 seconds", n=5)
    got = {}
    for r in out.orderBy("windowEnd", "rank").collect():
        got.setdefault((r.windowEnd // 1000) - BEHAVIOR_BASE, []).append(r.itemId)
    return got


def test_hot_items_recorded_runs(spark):
    assert hot(behavior_df(spark)) == EXPECTED_RUN1
    run2 = dict(EXPECTED_RUN1)
    run2[11] = [55, 66, 88, 99]
    assert hot(behavior_df(spark, BEHAVIOR_RUN2)) == run2
    assert hot(behavior_df(spark), H.hot_items_distinct_seconds) == EXPECTED_RUN1
    assert hot(behavior_df(spark), H.dedup_hot_items) == EXPECTED_RUN1


def test_hot_items_text(spark):
    lines = {r.windowEnd: r.value for r in H.hot_items_lines(behavior_df(spark), size="5 seconds",
                                                             slide="2 seconds").collect()}
    assert lines[(BEHAVIOR_BASE + 3) * 1000] == "1700000003000-11:1;1700000003000-22:1;"


def test_count_window_fixture(spark):
    for chunk, block in ((1 << 20, 1 << 20), (2, 10)):
        out = W.count_window(sensor_df(spark), "id", 10, 2, chunk_rows=chunk, block_rows=block)
        assert sorted((r.id, r.size) for r in out.collect()) == [
            ("sensor_1", 2), ("sensor_2", 2), ("sensor_2", 4), ("sensor_3", 2), ("sensor_4", 2), ("sensor_4", 4)]


def test_count_window_blocks_equal_single_block(spark, sf_dir):
    r = td.readings(spark, sf_dir)
    a = W.count_window(r, "id", 10, 2).collect()
    b = W.count_window(r, "id", 10, 2, chunk_rows=97, block_rows=13).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) > 0


def test_sessions_chunked_equal(spark, sf_dir):
    r = td.readings(spark, sf_dir)
    a = W.session_windows(r, "id", "1 hour").collect()
    b = W.session_windows(r, "id", "1 hour", chunk_ms=600_000).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert sum(x["count"] for x in a) == r.count()


def test_session_window_fixture(spark):
    out = W.session_windows(sensor_df(spark), "id", "10 seconds")
    got = sorted((r.id, (r.session_start - T0) // 1000, r["count"]) for r in out.collect())
    assert got == [("sensor_1", 3, 1), ("sensor_1", 21, 1), ("sensor_2", 0, 3), ("sensor_2", 31, 1), ("sensor_3", 7, 1),
                   ("sensor_3", 21, 1), ("sensor_4", 30, 4)]


def test_sessions_that_touch_merge_as_in_the_built_in(spark):
    # sensor_3's readings are exactly 14 s apart
    for chunk in (3_600_000, 1000):
        out = W.session_windows(sensor_df(spark), "id", "14 seconds", chunk_ms=chunk)
        got = {(r.id, r.session_start, r.session_end, r["count"]) for r in out.collect()}
        ev = sensor_df(spark).withColumn("e", F.timestamp_millis("timestamp"))
        own = ev.groupBy("id", F.session_window("e", "14 seconds").alias("w")).count().select(
            "id", F.unix_millis("w.start"), F.unix_millis("w.end"), "count")
        assert got == {tuple(r) for r in own.collect()}
        assert ("sensor_3", T0 + 7000, T0 + 35000, 2) in got


def test_window_size_text(spark):
    out = {r.value for r in W.window_size(sensor_df(spark), "15 seconds").collect()}
    assert "sensor_41700000145000" + "4" in out


def test_window_apply_general(spark):
    from typing import Any, Iterator, Tuple

    import pandas as pd

    def fn(key: Tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = sum(len(b) for b in batches)
        yield pd.DataFrame({"id": [key[2]], "window_end": [key[1]], "size": [n]})

    out = W.window_apply(sensor_df(spark), "15 seconds", "id", fn, "id string, window_end long, size long")
    assert sorted((r.id, r.size) for r in out.collect() if r.id == "sensor_4") == [("sensor_4", 4)]


def test_early_firing_and_keep_last(spark):
    out = W.early_firing(sensor_df(spark), "15 seconds", 2)
    assert sorted((r.id, r["count"], r.max_temperature) for r in out.collect()) == [
        ("sensor_2", 2, 21.5), ("sensor_4", 2, 9.25), ("sensor_4", 4, 12.0)]
    k = W.keep_last(sensor_df(spark), "15 seconds", 2).where("id = 'sensor_4'").first()
    assert (k.kept, k.min_temperature, k.sum_temperature) == (2, -3.5, 8.5)


def test_windows_epoch_aligned(spark):
    out = W.window_columns(sensor_df(spark), "timestamp", "15 seconds").where("seq = 1").first()
    assert out.window_start == T0 and out.window_end == T0 + 15000
    sl = W.window_columns(sensor_df(spark), "timestamp", "5 seconds", "2 seconds").where("seq = 1")
    assert sorted(r.window_start for r in sl.collect()) == [T0 - 4000, T0 - 2000, T0]
    assert sl.select(F.count("*")).first()[0] == 3
