import os

import pandas as pd
from pyspark.sql import functions as F

from streamweave.functions import udf
from streamweave.operators.windows import processing_time_window
from streamweave.sources.text import register_csv_stream
from streamweave.streaming import forms
from streamweave.streaming.runner import IdempotentParquetSink, run_available_now
from tests.fixtures import SENSOR_LINES, WORD_LINES, lines_df, sensor_df


def test_user_function_surface(spark):
    r = sensor_df(spark)

    def twice(s: pd.Series) -> pd.Series:
        return s * 2

    m = r.select(udf.map_column(twice, "double")(F.col("temperature")).alias("t"))
    assert sorted(x.t for x in m.collect())[-1] == 82.0

    def positive(s: pd.Series) -> pd.Series:
        return s > 0

    assert udf.filter_rows(r, "temperature", positive).count() == 11

    def words(b: pd.DataFrame) -> pd.DataFrame:
        rows = [(w,) for v in b["value"] for w in v.split(" ")]
        return pd.DataFrame(rows, columns=["word"])

    fm = udf.flat_map(lines_df(spark, WORD_LINES), words, "word string")
    assert fm.count() == 19

    def top(s: pd.Series) -> float:
        return float(s.max())

    ag = {x.id: x.value for x in udf.aggregate(r, "id", "temperature", top, top, "double").collect()}
    assert ag == {"sensor_1": 18.0, "sensor_2": 35.0, "sensor_3": 41.0, "sensor_4": 12.0}


def test_aggregate_calls_python_for_keys_not_rows(spark):
    """One input task, keys in turn: every batch holds every key."""
    calls = spark.sparkContext.accumulator(0)

    def top(s: pd.Series) -> float:
        calls.add(1)
        return float(s.max())

    df = spark.range(0, 40_000, 1, 1).select((F.col("id") % 2000).alias("k"), F.col("id").cast("double").alias("v"))
    got = {x.k: x.value for x in udf.aggregate(df, "k", "v", top, top, "double").collect()}
    assert got == {k: 38_000.0 + k for k in range(2000)}
    assert 2000 <= calls.value <= 2 * 2000
    assert {x.k: x.value for x in udf.aggregate(df, "k", "k", top, top, "double").collect()} == {k: float(k) for k in range(2000)}


def test_rows_are_gathered_by_key_and_share(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = spark.range(0, 10_000, 1, 1).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
        own = udf.gathered(many, "k", "v").withColumn("task", F.spark_partition_id())
        assert own.select("task").distinct().count() == 4  # from one input task
        assert own.groupBy("key").agg(F.count_distinct("task").alias("n")).where("n > 1").count() == 0
        assert own.agg(F.count("*"), F.sum("value")).first()[:] == (10_000, sum(range(10_000)))
        monkeypatch.setattr(udf, "SHARE_ROWS", 500)
        hot = udf.gathered(many.withColumn("k", F.lit("hot")), "k", "v").withColumn("task", F.spark_partition_id())
        assert hot.select("task").distinct().count() == 4 and hot.count() == 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_processing_time_window_batch(spark):
    out = processing_time_window(sensor_df(spark), "1 hour")
    assert out.where("window_end - window_start = 3600000").count() == 12


def test_csv_stream_and_processing_time_stream(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "a.csv").write_text("\n".join(SENSOR_LINES) + "\n")
    os.utime(d / "a.csv", (1_600_000_000, 1_600_000_000))
    t = register_csv_stream(spark, str(d), "sensor_csv_stream")
    sink = IdempotentParquetSink(str(tmp_path / "out"))
    run_available_now(spark.sql("select id, temp from sensor_csv_stream where id = 'sensor_4'"), sink,
                      str(tmp_path / "ck"))
    assert sink.read(spark).count() == 4
    pt = forms.processing_time_counts_stream(t, "id", "1 hour")
    s2 = IdempotentParquetSink(str(tmp_path / "pt"))
    run_available_now(pt, s2, str(tmp_path / "ck2"), output_mode="update")
    got = {r.id: r["count"] for r in s2.read(spark).collect()}
    assert got == {"sensor_1": 2, "sensor_2": 4, "sensor_3": 2, "sensor_4": 4}


def test_generated_stream(spark, tmp_path):
    import time

    from streamweave.sources.generator import generated_stream
    q = (generated_stream(spark, rows_per_second=50).writeStream.format("memory").queryName("sw_gen")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="500 milliseconds").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("sw_gen").count() == 0:
            time.sleep(0.5)
    finally:
        q.stop()
    r = spark.table("sw_gen").agg(F.count("*").alias("n"), F.max("temperature").alias("hi"),
                                  F.min(F.expr("id like 'senor_%'").cast("int")).alias("ok")).first()
    assert r.n > 0 and r.hi < 1.0 and r.ok == 1
