import pytest
from pyspark.sql import functions as F

from streamweave.operators import folds, partitioning, state
from streamweave.operators.scan import Scan, keyed_scan, seq_chunks
from streamweave.sinks.keyed import latest_per_key
from streamweave.sources import testdata as td
from streamweave.sources.text import parse_login
from tests.fixtures import L0, LOGIN_LINES, T0, lines_df, sensor_df


def by_seq(df, col):
    return [r[col] for r in df.orderBy("seq").collect()]


def test_running_counts(spark):
    for chunk in (1 << 20, 3):
        assert by_seq(state.running_count(sensor_df(spark), chunk), "count") == list(range(1, 13))
        assert by_seq(state.count_per_key(sensor_df(spark), chunk_rows=chunk), "count") == [1, 1, 2, 1, 3, 2, 2, 1, 2, 3, 4, 4]
        for block in (1 << 20, 2):
            v = state.last_values(sensor_df(spark), 2, block_rows=block, chunk_rows=chunk)
            assert by_seq(v, "list_size_before") == [0, 0, 1, 0, 2, 1, 1, 0, 1, 2, 3, 3]
            assert by_seq(v, "values") == [[], [], [20.5], [], [20.5, 21.5], [30.0], [18.0], [], [9.25], [9.25, 9.25],
                                           [9.25, -3.5], [21.5, 21.0]]


def test_jump_alert(spark):
    for chunk in (1 << 20, 2):
        out = state.temperature_jumps(sensor_df(spark), 10.0, chunk_rows=chunk)
        assert sorted((r.id, r.lastTemp, r.temperature) for r in out.collect()) == [
            ("sensor_1", 0.0, 18.0), ("sensor_2", 0.0, 20.5), ("sensor_2", 21.0, 35.0), ("sensor_3", 0.0, 30.0),
            ("sensor_3", 30.0, 41.0), ("sensor_4", -3.5, 12.0), ("sensor_4", 9.25, -3.5)]


def test_scan_keeps_null_order_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", 5), ("a", 9)], "k string, seq long")
    out = keyed_scan(df, ["k"], ["seq"], seq_chunks("seq", 4), [Scan("n", "count")])
    assert sorted((r.seq is None, r.n) for r in out.collect()) == [(False, 2), (False, 3), (True, 1)]


def test_scan_sum_skips_nulls_across_chunks(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 5, None), ("a", 6, 2)], "k string, seq long, v long")
    out = keyed_scan(df, ["k"], ["seq"], seq_chunks("seq", 4), [Scan("s", "sum", F.col("v"))])
    assert [r.s for r in out.orderBy("seq").collect()] == [5, 5, 5, 7]


def test_scan_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), (None, 4)], "k string, seq long")
    out = keyed_scan(df, ["k"], ["seq"], seq_chunks("seq", 2), [Scan("n", "count"), Scan("p", "lag", F.col("seq"), -1)])
    assert [(r.n, r.p) for r in out.orderBy("seq").collect()] == [(1, -1), (2, 1), (1, -1), (3, 2)]


def test_scan_chunk_sizes_agree(spark, sf_dir):
    r = td.readings(spark, sf_dir)
    specs = [Scan("c", "count"), Scan("m", "max", F.col("temperature")), Scan("s", "sum", F.col("seq")),
             Scan("l", "lag", F.col("temperature"), 0.0), Scan("f", "first", F.col("timestamp")),
             Scan("mb", "max_before", F.col("timestamp"))]
    a = keyed_scan(r, ["id"], ["seq"], seq_chunks("seq", 1 << 20), specs).collect()
    b = keyed_scan(r, ["id"], ["seq"], seq_chunks("seq", 7), specs).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_dedup_first(spark):
    df = spark.createDataFrame([(1, 10, 3), (1, 10, 1), (2, 10, 2), (1, 11, 4)], "itemId long, timestamp long, seq long")
    out = sorted(tuple(r) for r in state.dedup_first(df, ["itemId", "timestamp"]).collect())
    assert out == [(1, 10, 1), (1, 11, 4), (2, 10, 2)]


def test_last_value_per_id(spark):
    got = {r.id: r.temperature for r in latest_per_key(sensor_df(spark), "id", "temperature").collect()}
    assert got == {"sensor_1": 18.0, "sensor_2": 35.0, "sensor_3": 41.0, "sensor_4": 12.0}


def test_rising_alert_fixture(spark):
    for chunk in (3_600_000, 5_000):
        out = folds.rising_alerts(sensor_df(spark), "10 seconds", chunk_ms=chunk)
        got = sorted((r.id, (r.alert_time - T0) // 1000) for r in out.collect())
        assert got == [("sensor_1", 13), ("sensor_2", 10), ("sensor_2", 41), ("sensor_3", 17), ("sensor_3", 31),
                       ("sensor_4", 40)]


def test_rising_alert_chunking_agrees(spark, sf_dir):
    r = td.readings(spark, sf_dir)
    a = folds.rising_alerts(r, "1 day").collect()
    b = folds.rising_alerts(r, "1 day", chunk_ms=3_600_000 // 7).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) > 0


def test_login_fail_fixture(spark):
    logins = parse_login(lines_df(spark, LOGIN_LINES))
    out = folds.login_fail_warnings(logins, "2 seconds", 1)
    got = sorted((u, a - L0, b - L0, m) for u, a, b, m in out.collect())
    assert got == [(u, a, b, f"login fail in 2s for {n} times") for u, a, b, n in (
        (102, 1, 3, 2), (103, 4, 4, 1), (104, 10, 12, 3), (105, 21, 21, 1), (105, 24, 24, 1))]
    assert [r.userId for r in folds.login_fail_warnings(logins, "2 seconds", 3).collect()] == [104]


def test_partition_custom(spark):
    out = partitioning.partition_custom(sensor_df(spark), 4, partitioning.sensor_number_partition(4))
    got = {(r.id, r.p) for r in out.select("id", F.spark_partition_id().alias("p")).collect()}
    assert got == {("sensor_1", 0), ("sensor_2", 1), ("sensor_3", 2), ("sensor_4", 3)}
    with pytest.raises(Exception):
        partitioning.partition_custom(sensor_df(spark), 2, partitioning.sensor_number_partition(2)).collect()


def test_partition_helpers(spark):
    r = sensor_df(spark)
    assert partitioning.shuffle(r, 3).rdd.getNumPartitions() == 3
    assert partitioning.global_partition(r).rdd.getNumPartitions() == 1
    placed = {x.id: (x.subtasks, x.rows) for x in partitioning.key_placement(r, 4).collect()}
    assert placed == {"sensor_1": (1, 2), "sensor_2": (1, 4), "sensor_3": (1, 2), "sensor_4": (1, 4)}

    opened = []

    def open_fn():
        opened.append(1)
        return 10

    out = partitioning.map_partitions_with_resource(
        r.select("seq"), open_fn, lambda res, b: b.assign(seq=b.seq * res), lambda res: None, "seq long")
    assert sorted(x.seq for x in out.collect()) == [i * 10 for i in range(1, 13)]


def test_keyed_fold_custom_machine(spark):
    rows = [("a", 1, 1, 2.0), ("a", 2, 2, 3.0), ("a", 3, 3, -1.0), ("a", 4, 4, 5.0), ("b", 1, 5, 1.0),
            ("a", 9, 6, 1.0), ("b", 2, 7, -2.0), ("b", 3, 8, 4.0)]
    df = spark.createDataFrame(rows, "k string, t long, seq long, v double")

    def step(k, st, t, vals, out):
        return (st or 0.0) + vals[0]

    def finish(k, st, out):
        out.append((k, st))

    for width in (1000, 2):
        got = folds.keyed_fold(
            df, "k", "t", ["v"], F.struct(F.col("v").alias("v")),
            starts_here=lambda p: F.lit(False), ends_here=lambda p: F.col("v") < 0,
            step=step, finish=finish, out_schema="k string, total double", out_cols=["k", "total"],
            chunk_width=width)
        # a: [2, 3, -1] | [5, 1]; b: [1, -2] | [4]
        assert sorted(tuple(r) for r in got.collect()) == [("a", 4.0), ("a", 6.0), ("b", -1.0), ("b", 4.0)]
