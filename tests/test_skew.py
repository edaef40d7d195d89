"""A hot key holding a third of all rows: the chunked operators split it and
still equal the SQL result on the same skewed data."""

import duckdb
from pyspark.sql import functions as F

from streamweave.operators import folds, state, windows
from streamweave.operators.aggregates import rolling_max_by
from streamweave.sources import testdata as td
from tools.oracle_check import canon

HOT = "sensor_hot"


def skewed(spark, sf_dir):
    r = td.readings(spark, sf_dir)
    return r.withColumn("id", F.when(F.col("seq") % 3 == 0, F.lit(HOT)).otherwise(F.col("id")))


def duck(sf_dir, body):
    con = duckdb.connect()
    con.execute(f"""CREATE VIEW readings AS SELECT CASE WHEN event_id % 3 = 0 THEN '{HOT}'
                    ELSE 'sensor_' || CAST(user_id AS VARCHAR) END AS id, epoch_us(ts) // 1000 AS timestamp,
                    value AS temperature, event_id AS seq FROM read_parquet('{sf_dir}/events.parquet')""")
    res = con.execute(body)
    return canon([c[0] for c in res.description], res.fetchall())


def spark_rows(df):
    return canon(df.columns, [tuple(r) for r in df.collect()])


def test_hot_key_scans(spark, sf_dir):
    r = skewed(spark, sf_dir)
    # chunks of 50 arrivals: the hot key spans ~20 chunks
    assert spark_rows(state.count_per_key(r, chunk_rows=50)) == duck(
        sf_dir, "SELECT *, count(*) OVER (PARTITION BY id ORDER BY seq) AS count FROM readings")
    assert spark_rows(state.temperature_jumps(r, 10.0, chunk_rows=50)) == duck(sf_dir, """
        SELECT id, lastTemp, temperature, seq FROM (SELECT *, lag(temperature, 1, 0.0) OVER (PARTITION BY id
        ORDER BY seq) AS lastTemp FROM readings) WHERE abs(temperature - lastTemp) >= 10.0""")
    assert spark_rows(rolling_max_by(r, chunk_rows=50)) == duck(sf_dir, """
        SELECT seq AS input_seq, b.id AS id, b.ts AS timestamp, b.v AS temperature, b.s AS seq FROM (
        SELECT seq, max({'v': temperature, 'n': -seq, 'id': id, 'ts': timestamp, 's': seq}) OVER (PARTITION BY id
        ORDER BY seq) AS b FROM readings)""")
    cw = windows.count_window(r, "id", 10, 2, chunk_rows=50, block_rows=40)
    assert spark_rows(cw) == duck(sf_dir, """
        SELECT id, seq, size, min_temperature, max_temperature, id || CAST(size AS VARCHAR) AS value FROM (
        SELECT id, seq, row_number() OVER w AS rn, count(*) OVER f AS size, min(temperature) OVER f AS
        min_temperature, max(temperature) OVER f AS max_temperature FROM readings
        WINDOW w AS (PARTITION BY id ORDER BY seq),
               f AS (PARTITION BY id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE rn % 2 = 0""")


def test_hot_key_sessions_and_folds_agree_across_chunkings(spark, sf_dir):
    r = skewed(spark, sf_dir)
    a = windows.session_windows(r, "id", "1 hour")
    b = windows.session_windows(r, "id", "1 hour", chunk_ms=600_000)
    assert spark_rows(a) == spark_rows(b)
    assert spark_rows(a) == duck(sf_dir, """
        SELECT id, min(timestamp) AS session_start, max(timestamp) + 3600000 AS session_end, count(*) AS count FROM (
        SELECT *, sum(CASE WHEN prev IS NULL OR timestamp - prev > 3600000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY id ORDER BY timestamp, seq) AS sid FROM (
        SELECT *, lag(timestamp) OVER (PARTITION BY id ORDER BY timestamp, seq) AS prev FROM readings))
        GROUP BY id, sid""")
    x = folds.rising_alerts(r, "1 day")
    y = folds.rising_alerts(r, "1 day", chunk_ms=3_600_000 // 4)
    assert spark_rows(x) == spark_rows(y) and x.where(F.col("id") == HOT).count() > 0


def test_a_key_that_only_fails(spark):
    """A third of the rows is one user's, who never succeeds: rows collapse to one per second, chains of windows
    are found by pointers, and the result is that of the plain state machine."""
    rows = [(1, "fail", 1000 + i // 7, i) for i in range(4000)]
    rows += [(2 + i % 50, "fail" if i % 3 else "success", 1000 + i // 11, 10_000 + i) for i in range(8000)]
    df = spark.createDataFrame(rows, "userId long, loginState string, timestamp long, seq long")

    def machine(own, w):
        out, o = [], None
        for t, _, s in sorted((t, q, s) for _, s, t, q in own):
            if o and t > o[0] + w:
                out.append(tuple(o))
                o = None
            o = ([t, t, 1] if o is None else [o[0], t, o[2] + 1]) if s == "fail" else None
        return out + ([tuple(o)] if o else [])

    for w in (2, 60):
        want = sorted((u, a, b, f"login fail in {w}s for {n} times") for u in {r[0] for r in rows}
                      for a, b, n in machine([r for r in rows if r[0] == u], w))
        for chunk in (86_400, 10):
            got = folds.login_fail_warnings(df, f"{w} seconds", 1, chunk_width=chunk)
            assert sorted(map(tuple, got.collect())) == want


def test_long_rises_equal_the_state_machine(spark):
    import random
    rng = random.Random(4)
    rows, t, v = [], 0, 0.0
    for i in range(3000):
        t += rng.choice((0, 0, 1, 3, 40))
        v = v + rng.choice((0, 1, 1, 1, 1)) if rng.random() < 0.97 else v - 2
        rows.append(("a" if i % 3 else "b", t, v if rng.random() < 0.99 else None, i))
    df = spark.createDataFrame(rows, "id string, timestamp long, temperature double, seq long")

    def machine(own, n):
        # readings without a value take no part
        out, last, armed = [], 4.9e-324, None
        for x, _, y in sorted((x, q, y) for _, x, y, q in own if y is not None):
            if armed is not None and x > armed:
                out.append(armed)
                armed = None
            if y > last and armed is None:
                armed = x + n
            elif y < last:
                armed = None
            last = y
        return out + ([armed] if armed is not None else [])

    for n in (5, 200):
        want = sorted((k, a) for k in ("a", "b") for a in machine([r for r in rows if r[0] == k], n))
        for chunk in (3_600_000, 100):
            assert sorted(map(tuple, folds.rising_alerts(df, f"{n} ms", chunk_ms=chunk).collect())) == want


def test_alerts_of_a_null_key_and_of_several_batches(spark):
    rows = [(None, 1000, 1.0, 1), ("a", 1000, 2.0, 2), (None, 2000, 3.0, 3), ("a", 2000, 1.0, 4), (None, 9000, 2.0, 5), ("", 1000, 5.0, 6)]
    df = spark.createDataFrame(rows, "id string, timestamp long, temperature double, seq long")
    got = {(r.id, r.alert_time) for r in folds.rising_alerts(df, "2 seconds").collect()}
    assert got == {(None, 3000), ("", 3000)}
    logins = spark.createDataFrame([(None, "fail", 5, 1), (7, "fail", 5, 2), (None, "fail", 6, 3), (7, "success", 6, 4)],
                                   "userId long, loginState string, timestamp long, seq long")
    got = [tuple(r) for r in folds.login_fail_warnings(logins, "2 seconds", 1).collect()]
    assert got == [(None, 5, 6, "login fail in 2s for 2 times")]
