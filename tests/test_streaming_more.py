"""More stream = batch checks: rolling record aggregates, window sums,
distinct buckets, early firing."""

from streamweave.operators import aggregates as A, windows
from streamweave.sources import testdata as td
from streamweave.streaming import forms, processors as P
from streamweave.streaming.runner import use_rocksdb_state
from tests.test_streaming import event_files, ordered_mtimes, run, same, stream  # noqa: F401


def test_rolling_record_processors(spark, sf_dir, event_files, tmp_path):  # noqa: F811
    use_rocksdb_state(spark)
    r = td.readings_of(stream(spark, event_files))
    got = run(P.apply(r, "id", P.RollingMaxBy(), P.RollingMaxBy.schema()), tmp_path / "a")
    same(got.where("id <> 'sensor_-1'"), A.rolling_max_by(td.readings(spark, sf_dir)))
    got = run(P.apply(r, "id", P.RollingReduce(), P.RollingReduce.schema()), tmp_path / "b")
    same(got.where("id <> 'sensor_-1'"), A.rolling_reduce(td.readings(spark, sf_dir)))
    got = run(P.apply(r, "id", P.RollingMax(), P.RollingMax.schema()), tmp_path / "c")
    want = A.rolling_max(td.readings(spark, sf_dir)).select("input_seq", "id", "timestamp", "temperature")
    same(got.where("id <> 'sensor_-1'"), want)


def test_window_sum_and_distinct_buckets_stream(spark, sf_dir, event_files, tmp_path):  # noqa: F811
    r = td.readings_of(stream(spark, event_files))
    got = run(forms.window_sum_stream(r, "1 hour", scale=2), tmp_path / "s")
    same(got.where("id <> 'sensor_-1'"), A.window_sum(td.readings(spark, sf_dir), "1 hour", scale=2))
    b = td.behaviors_of(stream(spark, event_files)).where("behavior = 'pv'")
    got = run(forms.distinct_buckets_stream(b, "itemId", "5 hours", "2 hours"), tmp_path / "d")
    want = A.window_distinct_buckets(td.behaviors(spark, sf_dir).where("behavior = 'pv'"), "5 hours", "itemId",
                                     slide="2 hours")
    same(got.where("itemId <> -1"), want)


def test_early_firing_processor(spark, sf_dir, event_files, tmp_path):  # noqa: F811
    use_rocksdb_state(spark)
    r = windows.window_columns(td.readings_of(stream(spark, event_files)), "timestamp", "1 day")
    r = forms.with_event_time(r).withWatermark("event_time", forms.ASCENDING)
    got = run(P.apply_multi(r, ["id", "window_start"], P.EarlyFiring(2), P.EarlyFiring.schema(), "EventTime"),
              tmp_path / "e")
    want = windows.early_firing(td.readings(spark, sf_dir), "1 day", 2)
    assert want.count() > 0
    same(got.where("id <> 'sensor_-1'"), want)


def test_dedup_hot_items_stream(spark, sf_dir, event_files, tmp_path):  # noqa: F811
    from streamweave.plans.hot_items import dedup_hot_items
    counts = forms.dedup_hot_items_counts_stream(td.behaviors_of(stream(spark, event_files)))
    got = run(counts, tmp_path / "c")
    sink = forms.hot_items_sink(str(tmp_path / "top"))
    from streamweave.streaming.runner import run_available_now
    run_available_now(forms.dedup_hot_items_counts_stream(td.behaviors_of(stream(spark, event_files))), sink,
                      str(tmp_path / "ck2"))
    same(sink.read(spark).drop("batch_id").where("itemId <> -1"), dedup_hot_items(td.behaviors(spark, sf_dir)))
    assert got.count() > 0


def one_row_files(spark, d, rows, schema):
    """One file, and so one micro-batch, for each row, in order; the stream over them."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    types = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
    fields = [c.split() for c in schema.split(", ")]
    d.mkdir()
    for i, row in enumerate(rows):
        pq.write_table(pa.table({n: pa.array([v], types[t]) for (n, t), v in zip(fields, row)}), d / f"p{i:03d}.parquet")
    ordered_mtimes(d)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(d))


def test_rows_of_one_second_in_many_batches_are_all_kept(spark, tmp_path):
    """The watermark stands at the newest instant: rows of later batches that share it are not late (ST11, E2)."""
    from streamweave.operators.state import dedup_first
    from streamweave.plans.hot_items import dedup_hot_items
    from streamweave.streaming.runner import run_available_now
    rows = [(1, 100, "pv", 1), (2, 105, "pv", 2), (3, 105, "pv", 3), (2, 105, "pv", 4), (4, 105, "pv", 5), (5, 105, "pv", 6),
            (6, 105, "pv", 7), (1, 10 ** 6, "pv", 8)]
    schema = "itemId long, timestamp long, behavior string, seq long"
    src = one_row_files(spark, tmp_path / "in", rows, schema)
    batch = spark.createDataFrame(rows, schema)
    got = run(forms.dedup_stream(src, ["itemId", "timestamp"]), tmp_path / "d")
    same(got, dedup_first(batch, ["itemId", "timestamp"]))
    sink = forms.hot_items_sink(str(tmp_path / "e2"), 10)
    run_available_now(forms.dedup_hot_items_counts_stream(src, "10 seconds", "5 seconds"), sink, str(tmp_path / "ck"))
    want = dedup_hot_items(batch, "10 seconds", "5 seconds", 10).where("windowEnd < 1000000")
    same(sink.read(spark).drop("batch_id").where("windowEnd < 1000000"), want)
    assert want.where("itemId in (3, 4, 5, 6)").count() == 8


def test_event_time_folds_with_many_batches_in_one_second(spark, tmp_path):
    from streamweave.operators import folds
    use_rocksdb_state(spark)
    rows = [("u", 1000, 1.0, 1), ("v", 5000, 2.0, 2), ("w", 5000, 3.0, 3), ("x", 5000, 1.5, 4), ("y", 5000, 4.0, 5),
            ("x", 5000, 1.0, 6), ("z", 5000, 2.0, 7), ("end", 10 ** 9, -1.0, 8)]
    schema = "id string, timestamp long, temperature double, seq long"
    src = one_row_files(spark, tmp_path / "r", rows, schema)
    ev = forms.with_event_time(src).withWatermark("event_time", forms.ASCENDING)
    got = run(P.apply(ev, "id", P.RisingAlert("2 seconds"), P.RisingAlert.schema(), "EventTime"), tmp_path / "a")
    same(got, folds.rising_alerts(spark.createDataFrame(rows, schema), "2 seconds"))
    rows = [(1, "fail", 10, 1), (2, "fail", 10, 2), (1, "fail", 10, 3), (3, "fail", 10, 4), (2, "success", 10, 5),
            (4, "fail", 10, 6), (2, "fail", 10, 7), (9, "success", 10 ** 6, 8)]
    schema = "userId long, loginState string, timestamp long, seq long"
    src = one_row_files(spark, tmp_path / "l", rows, schema)
    ev = forms.with_event_time(src, unit="s").withWatermark("event_time", forms.ASCENDING)
    got = run(P.apply(ev, "userId", P.LoginFail("2 seconds", 1), P.LoginFail.schema(), "EventTime"), tmp_path / "b")
    want = folds.login_fail_warnings(spark.createDataFrame(rows, schema), "2 seconds", 1)
    assert want.count() == 4
    same(got, want)


def test_window_min_stream_fires_at_close_and_per_late_row(spark, tmp_path):
    from streamweave.operators.lateness import firing_changelog_min_by, late_output
    from tests.test_lateness import ARRIVALS
    use_rocksdb_state(spark)
    base = 1_700_000_000_000  # the engine has no watermark before the epoch
    rows = [*ARRIVALS, ("b", 22000, 4.0, 8), ("b", 22500, 6.0, 9), ("b", 31000, 1.0, 10), ("b", 24000, 3.0, 11),
            ("end", 10 ** 9, 0.0, 12), ("end", 10 ** 9 + 1, 0.0, 13)]
    rows = [(k, base + t, v, s) for k, t, v, s in rows]
    schema = "id string, timestamp long, temperature double, seq long"
    src = one_row_files(spark, tmp_path / "in", rows, schema)
    got = run(forms.window_min_stream(src, "10 seconds", "0 ms", "5 seconds"), tmp_path / "w").where("id <> 'end'")
    batch = spark.createDataFrame(rows, schema)
    cols = ["id", "window_start", "window_end", "firing", "trigger_seq", "timestamp", "temperature", "seq"]
    same(got.where("firing <> 'too_late'").select(cols),
         firing_changelog_min_by(batch, "10 seconds", "0 ms", "5 seconds").where("id <> 'end'").select(cols))
    late = late_output(batch, "10 seconds", "0 ms", "5 seconds")
    assert sorted(r.seq for r in got.where("firing = 'too_late'").collect()) == sorted(r.seq for r in late.collect())
