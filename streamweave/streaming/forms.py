"""Streaming forms built on Spark's stateful operators.

Sources are file streams (parquet or text folders); Kafka and sockets are
in ``streamweave.sources.external``. Event time is a TIMESTAMP column
``event_time`` (watermarks reject TIMESTAMP_NTZ). Windows emit in append
mode when the watermark passes their end; the windows that a bounded
replay leaves open are read from the query's state (``open_windows``).

Input in ascending time is watermarked one millisecond behind its newest
row (``ASCENDING``): with no lag at all, rows of a later micro-batch that
share the newest row's instant would count as late and be dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweave.functions.time import duration_ms, spark_interval
from streamweave.operators.aggregates import exact_sum
from streamweave.operators.topn import hot_items_top_n
from streamweave.sources import testdata as td
from streamweave.operators.windows import window_columns
from streamweave.streaming.processors import WindowMin, apply_multi
from streamweave.streaming.runner import IdempotentParquetSink, run_available_now


ASCENDING = "1 millisecond"
#: Files of a micro-batch, which bounds what a processor sorts per key.
MAX_FILES = 64


def events_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = MAX_FILES,
                  file_glob: str | None = None) -> DataFrame:
    """Events files arriving in ``folder`` (optionally only names matching
    ``file_glob``), read in modification-time order, ``max_files_per_trigger``
    at a time, so a backlog never becomes one micro-batch."""
    r = spark.readStream.schema(td.EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    return r.parquet(folder)


def with_event_time(df: DataFrame, col: str = "timestamp", unit: str = "ms") -> DataFrame:
    conv = F.timestamp_millis if unit == "ms" else F.timestamp_seconds
    return df.withColumn("event_time", conv(F.col(col)))


def _bounds(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", F.unix_millis(F.col("window.start")))
              .withColumn("window_end", F.unix_millis(F.col("window.end"))).drop("window"))


def window_counts_stream(df: DataFrame, key: str, size: str, slide: str | None = None,
                         delay: str = ASCENDING, unit: str = "s") -> DataFrame:
    """W1/W3/W8 + A8 on a stream: count per (window, key), append mode."""
    ev = with_event_time(df, unit=unit).withWatermark("event_time", spark_interval(delay))
    win = F.window("event_time", spark_interval(size)) if slide is None else \
        F.window("event_time", spark_interval(size), spark_interval(slide))
    return _bounds(ev.groupBy(win, key).agg(F.count(F.lit(1)).alias("count")))


def window_sum_stream(readings: DataFrame, size: str, key: str = "id", field: str = "temperature",
                      delay: str = ASCENDING, scale: int | None = None) -> DataFrame:
    """A7 on a stream: sum of ``field`` per (window, key), append mode."""
    ev = with_event_time(readings).withWatermark("event_time", spark_interval(delay))
    agg = ev.groupBy(F.window("event_time", spark_interval(size)), key).agg(
        exact_sum(F.col(field), scale).alias(f"sum_{field}"))
    return _bounds(agg).select("window_start", "window_end", key, f"sum_{field}")


def distinct_buckets_stream(df: DataFrame, key: str, size: str, slide: str, bucket: int = 1000,
                            delay: str = ASCENDING) -> DataFrame:
    """A9 on a stream: distinct ``timestamp / bucket`` per (window, key).
    Streaming has no distinct aggregate; two chained stateful aggregations
    do it: count per (window, key, bucket), then rows per (window, key)."""
    ev = with_event_time(df, unit="s").withWatermark("event_time", spark_interval(delay))
    b = F.expr(f"timestamp div {int(bucket)}")
    per_bucket = ev.groupBy(F.window("event_time", spark_interval(size), spark_interval(slide)), key,
                            b.alias("__b")).count()
    per_key = per_bucket.groupBy("window", key).agg(F.count(F.lit(1)).alias("count"))
    return _bounds(per_key).select("window_start", "window_end", key, "count")


def hot_items_counts_stream(behaviors: DataFrame, size: str = "5 hours", slide: str = "2 hours") -> DataFrame:
    """E1 stage 1: ItemViewCount rows, final per window (ascending time, T3)."""
    pv = behaviors.where(F.col("behavior") == "pv").select("itemId", "timestamp")
    c = window_counts_stream(pv, "itemId", size, slide, unit="s")
    return c.select("itemId", F.col("window_end").alias("windowEnd"), "count")


def dedup_hot_items_counts_stream(behaviors: DataFrame, size: str = "5 hours",
                                  slide: str = "2 hours") -> DataFrame:
    """E2 stage 1: (itemId, timestamp) de-duplicated within the watermark,
    then sliding counts; two chained stateful operators."""
    pv = behaviors.where(F.col("behavior") == "pv").select("itemId", "timestamp")
    ev = with_event_time(pv, unit="s").withWatermark("event_time", ASCENDING)
    first = ev.dropDuplicatesWithinWatermark(["itemId", "timestamp"])
    win = F.window("event_time", spark_interval(size), spark_interval(slide))
    c = _bounds(first.groupBy(win, "itemId").agg(F.count(F.lit(1)).alias("count")))
    return c.select("itemId", F.col("window_end").alias("windowEnd"), "count")


def hot_items_sink(path: str, n: int = 5) -> IdempotentParquetSink:
    """E1 stage 2 (ST13): rank each micro-batch's final window counts. In
    append mode every window's counts arrive complete in one batch, so the
    batch top-n is exact, and it is a distributed two-phase
    WindowGroupLimit, not a per-window list in one task."""
    return IdempotentParquetSink(path, lambda b: hot_items_top_n(b, n))


def open_windows(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """(key, window_end, count) of the windows a stopped ``window_counts_stream``
    has not emitted yet: what its state still holds."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col(f"key.{key}").alias(key), F.unix_millis(F.col("key.window.end")).alias("window_end"),
                        F.col("value.count").alias("count"))


def hot_items_stream_run(spark: SparkSession, sf_dir: str, out_dir: str, max_files_per_trigger: int | None = MAX_FILES):
    """Hot items over the events file as a stream, to completion: every window
    is emitted when the watermark passes it, and at the end of the input the
    open ones are flushed from the state, as one more batch of the sink."""
    ev = events_stream(spark, sf_dir, max_files_per_trigger, file_glob="events.parquet")
    counts = hot_items_counts_stream(td.pageviews_of(ev))
    sink, checkpoint = hot_items_sink(f"{out_dir}/out"), f"{out_dir}/checkpoint"
    run_available_now(counts, sink, checkpoint)
    rest = open_windows(spark, checkpoint, "itemId").withColumnRenamed("window_end", "windowEnd")
    sink(rest, sink.last_batch(spark) + 1)
    return sink


def word_count_stream(lines: DataFrame) -> DataFrame:
    """E4 / A2 on a stream: counts per word, update mode (one row per
    changed word per micro-batch)."""
    w = td.words_of(lines)
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def window_min_stream(readings: DataFrame, size: str, delay: str = "1 millisecond", lateness: str = "0 ms") -> DataFrame:
    """The firings of minBy per (id, window), as in
    ``operators.lateness``: one result when the watermark (newest time -
    ``delay``) passes the window, one more for each late row that is still
    allowed. Rows that are too late come out as ``too_late`` with their own
    values (W10): one stateful query, no second watermark beside the
    engine's. Needs the RocksDB state store.

    The engine's watermark runs ``size + lateness`` behind the window
    clock, so it drops no row of a window that may still fire; a row later
    than that has been too late for long, and the engine counts it as dropped.
    """
    size_ms, late_ms = duration_ms(size), duration_ms(lateness)
    wm = f"{duration_ms(delay) + late_ms + size_ms} milliseconds"
    rows = window_columns(readings, "timestamp", size)
    rows = with_event_time(rows).withWatermark("event_time", wm)
    return apply_multi(rows, ["id", "window_start"], WindowMin(size_ms, late_ms), WindowMin.schema(), "EventTime")


def dedup_stream(df: DataFrame, keys: list[str], delay: str = ASCENDING, unit: str = "s") -> DataFrame:
    """ST11 on a stream: first row per key within the watermark (with a
    delay above 0: see ``ASCENDING``)."""
    ev = with_event_time(df, unit=unit).withWatermark("event_time", spark_interval(delay))
    return ev.dropDuplicatesWithinWatermark(keys).drop("event_time")


def session_stream(readings: DataFrame, gap: str, delay: str = ASCENDING) -> DataFrame:
    """W4 on a stream: session windows per id (append)."""
    ev = with_event_time(readings).withWatermark("event_time", spark_interval(delay))
    s = ev.groupBy(F.session_window("event_time", spark_interval(gap)).alias("w"), "id").agg(
        F.count(F.lit(1)).alias("count"))
    return s.select("id", F.unix_millis("w.start").alias("session_start"), F.unix_millis("w.end").alias("session_end"),
                    "count")


def processing_time_counts_stream(df: DataFrame, key: str, size: str) -> DataFrame:
    """Windows on processing time (no watermark; update mode)."""
    pt = df.withColumn("processing_time", F.current_timestamp())
    return _bounds(pt.groupBy(F.window("processing_time", spark_interval(size)), key).count())
