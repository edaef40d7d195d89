"""Windows.

Time windows are Spark's ``window`` / ``session_window`` columns over an
event-time TIMESTAMP, epoch-aligned like the reference's; results carry
``window_start`` / ``window_end`` as epoch milliseconds, as the
reference's ``windowEnd`` does. Count windows use ``keyed_scan`` so a hot
key is split into chunks; session windows merge chunk by chunk of time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from streamweave.functions.time import duration_ms, spark_interval
from streamweave.operators.panes import sliding_aggregate
from streamweave.operators.scan import DEFAULT_CHUNK_ROWS, Scan, keyed_scan, order_chunks, seq_chunks

DEFAULT_CHUNK_MS = 3_600_000  # event-time chunk of a keyed scan: one hour


def _event_time(df: DataFrame, time_col: str, unit: str):
    c = F.col(time_col)
    return F.timestamp_millis(c) if unit == "ms" else F.timestamp_seconds(c)


def window_columns(df: DataFrame, time_col: str, size: str, slide: str | None = None,
                   unit: str = "ms") -> DataFrame:
    """Assign tumbling (``slide`` None) or sliding windows.

    Adds ``window_start`` / ``window_end`` (epoch ms). A sliding window
    repeats each row size/slide times (rounded up): aggregates that merge
    go by ``panes`` instead, which copies no raw row.
    """
    ev = _event_time(df, time_col, unit)
    win = F.window(ev, spark_interval(size)) if slide is None else \
        F.window(ev, spark_interval(size), spark_interval(slide))
    return (df.withColumn("__w", win)
            .withColumn("window_start", F.unix_millis(F.col("__w.start")))
            .withColumn("window_end", F.unix_millis(F.col("__w.end")))
            .drop("__w"))


def processing_time_window(df: DataFrame, size: str) -> DataFrame:
    """Window on the processing time of each row (streams)."""
    return (df.withColumn("processing_time", F.current_timestamp())
            .withColumn("__w", F.window("processing_time", spark_interval(size)))
            .withColumn("window_start", F.unix_millis(F.col("__w.start")))
            .withColumn("window_end", F.unix_millis(F.col("__w.end")))
            .drop("__w"))


def session_windows(df: DataFrame, key: str, gap: str, time_col: str = "timestamp",
                    chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """W4 session windows per key: a session goes on while the gap to the
    key's previous event is <= ``gap`` (touching sessions merge, as in
    ``session_window`` and in the stream form).

    Output: (key, session_start, session_end = last event + gap, count),
    times in epoch ms. Three steps over ever smaller tables: rows of one
    (key, time) are counted map-side; inside a chunk of time they become the
    chunk's own sessions; those are merged along the key. No step's groups
    grow with the number of rows: a chunk has at most ``chunk_ms`` distinct
    times, and chunk_ms / gap + 1 sessions go on to the merge.
    """
    g = duration_ms(gap)
    times = df.groupBy(key, F.col(time_col).cast("bigint").alias("__t")).agg(F.count(F.lit(1)).alias("__n"))
    times = times.withColumn("__chunk", F.expr(f"__t div {int(chunk_ms)}"))

    def merged(spans: DataFrame, part: list[str]) -> DataFrame:
        """(first, last, n) spans in order -> maximal groups of spans within the gap."""
        w = Window.partitionBy(*part).orderBy("__first")
        so_far = w.rowsBetween(Window.unboundedPreceding, -1)
        new = F.coalesce(F.col("__first") - F.max("__last").over(so_far) > g, F.lit(True))
        ids = spans.withColumn("__new", F.when(new, F.col("__first")))
        ids = ids.withColumn("__id", F.max("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return ids.groupBy(*part, "__id").agg(F.min("__first").alias("__first"), F.max("__last").alias("__last"),
                                              F.sum("__n").alias("__n")).drop("__id")

    spans = merged(times.select(key, "__chunk", F.col("__t").alias("__first"), F.col("__t").alias("__last"), "__n"),
                   [key, "__chunk"])
    return merged(spans.drop("__chunk"), [key]).select(
        key, F.col("__first").alias("session_start"), (F.col("__last") + F.lit(g)).alias("session_end"),
        F.col("__n").alias("count"))


def count_window(df: DataFrame, key: str = "id", size: int = 10, slide: int = 2,
                 field: str = "temperature", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                 block_rows: int = DEFAULT_CHUNK_ROWS, order: Sequence[str] = ("seq",)) -> DataFrame:
    """W5 ``countWindow(size, slide)``: at every ``slide``-th row of a key,
    the last ``size`` rows at most; an incomplete tail never fires.

    Output per firing: (key, order columns of the firing row, size, min/max
    of ``field``, and the text ``id + size``). Rows are numbered per key with a chunked scan, then cut into
    blocks of ``block_rows`` with a halo of ``size - 1`` rows copied from
    the previous block, so each frame is computed inside one block.
    """
    if block_rows < size:
        raise ValueError("block_rows must be >= size")
    order = list(order)
    numbered = keyed_scan(df, [key], order, order_chunks(order, chunk_rows), [Scan("__rn", "count")])
    pos = F.expr(f"(__rn - 1) % {int(block_rows)}")
    # Each row goes to its block; the last size-1 rows of a block are also
    # copied (as halo) into the next one. One pass, no union of two plans.
    copies = F.when(pos >= block_rows - size + 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    blocks = (numbered.withColumn("__copy", F.explode(copies))
              .withColumn("__blk", F.expr(f"(__rn - 1) div {int(block_rows)}") + F.col("__copy"))
              .withColumn("__halo", F.col("__copy") == 1))
    w = Window.partitionBy(key, "__blk").orderBy("__rn").rowsBetween(-(size - 1), Window.currentRow)
    return (blocks
            .select(key, *order, "__rn", "__halo",
                    F.count(F.lit(1)).over(w).alias("size"),
                    F.min(field).over(w).alias(f"min_{field}"),
                    F.max(field).over(w).alias(f"max_{field}"))
            .where(~F.col("__halo") & (F.col("__rn") % slide == 0))
            .withColumn("value", F.concat(F.col(key).cast("string"), F.col("size").cast("string")))
            .drop("__rn", "__halo"))


def window_size(df: DataFrame, size: str, key: str = "id", time_col: str = "timestamp") -> DataFrame:
    """W6 ``apply(WindowFunction)`` of the reference: id + windowEnd + size,
    as the built-in count (partial aggregation; no group is buffered)."""
    w = window_columns(df, time_col, size)
    return (w.groupBy(key, "window_start", "window_end").agg(F.count(F.lit(1)).alias("size"))
            .withColumn("value", F.concat(F.col(key), F.col("window_end").cast("string"),
                                          F.col("size").cast("string"))))


def window_apply(df: DataFrame, size: str, key: str, fn: Callable, schema: StructType | str,
                 time_col: str = "timestamp", slide: str | None = None) -> DataFrame:
    """W6/W7 general full-window function: ``fn(key, batches)`` sees every row
    of one (window_start, window_end, key) group as an iterator of pandas
    batches (the key tuple carries the window bounds, as a
    ProcessWindowFunction's context does). Annotate ``fn`` as
    ``(Tuple[Any, ...], Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]``
    so Spark streams the group in batches: memory per group is one batch.
    Prefer built-in aggregates where they express the result."""
    w = window_columns(df, time_col, size, slide)
    return w.groupBy("window_start", "window_end", key).applyInPandas(fn, schema)


def item_view_counts(df: DataFrame, size: str, slide: str, key: str = "itemId",
                     time_col: str = "timestamp", unit: str = "s") -> DataFrame:
    """W8 ``aggregate(count, WindowFunction)``: ItemViewCount(itemId, windowEnd, count), counted once per pane."""
    w = sliding_aggregate(df, key, size, slide, time_col, {"count": (F.count(F.lit(1)), F.sum)}, unit)
    return w.select(F.col(key).alias("itemId"), F.col("window_end").alias("windowEnd"), "count")


def early_firing(df: DataFrame, size: str, every: int, key: str = "id", field: str = "temperature",
                 time_col: str = "timestamp", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W11 (re-aimed custom trigger): inside each (key, window), emit the
    running result at every ``every``-th arrival."""
    w = window_columns(df, time_col, size)
    out = keyed_scan(w, [key, "window_start"], ["seq"], seq_chunks("seq", chunk_rows),
                     [Scan("count", "count"), Scan(f"max_{field}", "max", F.col(field))])
    return (out.where(F.col("count") % every == 0)
            .select(key, "window_start", "window_end", F.col("seq").alias("fired_at_seq"), "count",
                    f"max_{field}"))


def keep_last(df: DataFrame, size: str, m: int, key: str = "id", field: str = "temperature",
              time_col: str = "timestamp", scale: int | None = None) -> DataFrame:
    """W12 (re-aimed evictor): keep the last ``m`` arrivals of each (key,
    window), then aggregate. The rank filter is planned as a partial
    WindowGroupLimit before the shuffle, so at most m rows per group move."""
    w = window_columns(df, time_col, size)
    rk = Window.partitionBy(key, "window_start").orderBy(F.col("seq").desc())
    kept = w.withColumn("__rk", F.row_number().over(rk)).where(F.col("__rk") <= m)
    agg = F.sum(F.col(field).cast(f"decimal(18,{scale})")).cast("double") if scale is not None else F.sum(field)
    return kept.groupBy(key, "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("kept"), F.min(field).alias(f"min_{field}"), agg.alias(f"sum_{field}"))
