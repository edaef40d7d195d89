"""Watermarks, allowed lateness and late output in bounded form
(SURVEY §2.8 T5/T6, §2.5 W9/W10).

A bounded input replays a stream in its arrival order ``seq``. The
watermark a row meets is ``max(timestamp of earlier arrivals) - delay``
(a bounded-out-of-orderness extractor emitting after every row). With
a window's last timestamp ``end - 1``:

* on time        watermark < end - 1 (or no watermark yet);
* late, allowed  end - 1 <= watermark < end - 1 + lateness: the window
                 fires again with the row added;
* too late       end - 1 + lateness <= watermark: dropped from the
                 window and sent to the late output.

The global running max is a chunked scan (no one-partition window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from streamweave.functions.time import duration_ms
from streamweave.operators.scan import DEFAULT_CHUNK_ROWS, Scan, keyed_scan, order_chunks
from streamweave.operators.windows import window_columns

ON_TIME, LATE, TOO_LATE = "on_time", "late", "too_late"


def classify_arrivals(df: DataFrame, size: str, delay: str, lateness: str = "0 ms", time_col: str = "timestamp",
                      chunk_rows: int = DEFAULT_CHUNK_ROWS, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per row its tumbling window, the watermark it met and its class.
    ``order``: the arrival order, e.g. (partition, offset) of a topic."""
    d, lt = duration_ms(delay), duration_ms(lateness)
    wm = keyed_scan(df, [], list(order), order_chunks(list(order), chunk_rows),
                    [Scan("__max_before", "max_before", F.col(time_col))])
    wm = wm.withColumn("watermark", F.col("__max_before") - F.lit(d)).drop("__max_before")
    w = window_columns(wm, time_col, size)
    last = F.col("window_end") - F.lit(1)
    cls = (F.when(F.col("watermark").isNull() | (F.col("watermark") < last), F.lit(ON_TIME))
           .when(F.col("watermark") < last + F.lit(lt), F.lit(LATE))
           .otherwise(F.lit(TOO_LATE)))
    return w.withColumn("arrival", cls)


def late_output(df: DataFrame, size: str, delay: str, lateness: str = "0 ms", **kw) -> DataFrame:
    """W10 ``sideOutputLateData``: the rows too late for their window."""
    c = classify_arrivals(df, size, delay, lateness, **kw)
    return c.where(F.col("arrival") == TOO_LATE).drop("arrival")


def firing_changelog_min_by(df: DataFrame, size: str, delay: str, lateness: str, key: str = "id",
                            field: str = "temperature", time_col: str = "timestamp",
                            chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W9 ``allowedLateness`` + ``minBy``: one row per window firing.

    ``on_time``: the result when the watermark passes the window (all its
    on-time rows); ``late``: one updated result per allowed late row, over
    the on-time rows and the late rows that arrived so far. Every on-time
    row of a window arrives before every late row of it (the watermark only
    grows), so ties keep the earliest arrival, as minBy does. The result
    record is (timestamp, temperature, seq) of the minimum.
    """
    c = classify_arrivals(df, size, delay, lateness, time_col=time_col, chunk_rows=chunk_rows)
    rec = F.struct(F.col(field).alias("v"), F.col("seq").alias("s"), F.col(time_col).alias("t"))
    late = F.col("arrival") == LATE
    # On-time rows of a window become one row map-side; a late row stays one.
    kept = (c.where(F.col("arrival") != TOO_LATE)
            .groupBy(key, "window_start", "window_end", F.when(late, F.col("seq")).alias("__late"))
            .agg(F.min(rec).alias("__m"), F.max("seq").alias("trigger_seq")))
    # In arrival order, the on-time row first (the watermark only grows): the
    # running minimum is each firing's result.
    upto = Window.partitionBy(key, "window_start").orderBy(F.col("__late").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fired = kept.withColumn("__m", F.min("__m").over(upto))
    return fired.select(key, "window_start", "window_end",
                        F.when(F.col("__late").isNull(), F.lit(ON_TIME)).otherwise(F.lit(LATE)).alias("firing"),
                        "trigger_seq", F.col("__m.t").alias(time_col), F.col("__m.v").alias(field),
                        F.col("__m.s").alias("seq"))
