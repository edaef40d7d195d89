"""Aggregations.

Each keyed aggregate has a ``final`` form (one row per key or window,
Catalyst's partial + final HashAggregate, so hot keys are pre-aggregated
map-side) and, where the reference emits one row per input, a
``changelog`` form built on ``keyed_scan`` (hot keys split into chunks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from streamweave.operators.panes import sliding_aggregate, sliding_distinct
from streamweave.operators.scan import DEFAULT_CHUNK_ROWS, Scan, keyed_scan, seq_chunks
from streamweave.operators.windows import window_columns


def exact_sum(col: Column, scale: int | None = None) -> Column:
    """The sum of the doubles as they are. A caller that knows its data's
    decimal scale may pass it: the sum is then exact in any row order (and
    returned as double)."""
    if scale is None:
        return F.sum(col)
    return F.sum(col.cast(f"decimal(18,{scale})")).cast("double")


# ---- A1 / A2 word count -------------------------------------------------

def word_count(words: DataFrame, col: str = "word") -> DataFrame:
    """A1 ``groupBy(0).sum(1)``: (word, count)."""
    return words.groupBy(F.col(col).alias("word")).agg(F.count(F.lit(1)).alias("count"))


#: At some hundred words a document, a chunk of one word alone stays below DEFAULT_CHUNK_ROWS; the result doesn't depend on it.
DOCS_PER_CHUNK = 2048


def rolling_word_count(words: DataFrame, col: str = "word", order: Sequence[str] = ("doc_id", "line_no", "pos"),
                       per_chunk: int = DOCS_PER_CHUNK, chunk: list[Column] | None = None) -> DataFrame:
    """A2 ``keyBy(word).sum(1)``: per input word, its count so far.

    Words are in the order of the ``order`` columns, compared as they are (no
    packed number that could overflow). Chunks are ranges of ``per_chunk``
    values of the first of them (documents, or lines of a text file), or the
    columns ``chunk``, so a frequent word is split while the chunk summary
    stays far smaller than the input. Text is split into words once: running counts and totals
    read one exchange, and only the running counts sort it."""
    df = words.select(F.col(col).alias("word"), *order)
    return keyed_scan(df, ["word"], list(order), chunk or seq_chunks(order[0], per_chunk), [Scan("count", "count")],
                      one_pass=True)


# ---- A3 / A4 / A5 rolling aggregates on readings -------------------------

_READING_FIELDS = ("id", "timestamp", "temperature", "seq")


def rolling_max_by(df: DataFrame, key: str = "id", field: str = "temperature",
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """A3 ``maxBy(field)``: after each input, the whole record holding the
    max so far; a tie keeps the earlier record."""
    payload = F.struct(*[F.col(c) for c in df.columns])
    best = F.struct(F.col(field).alias("v"), (-F.col("seq")).alias("neg_seq"), payload.alias("r"))
    out = keyed_scan(df, [key], ["seq"], seq_chunks("seq", chunk_rows), [Scan("__best", "max", best)])
    return out.select(F.col("seq").alias("input_seq"),
                      *[F.col("__best.r").getField(c).alias(c) for c in df.columns])


def rolling_max(df: DataFrame, key: str = "id", field: str = "temperature",
                chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """A4 ``max(field)``: running max; the other fields stay from the key's
    first record."""
    others = [c for c in df.columns if c not in (key, field, "seq")]
    out = keyed_scan(df, [key], ["seq"], seq_chunks("seq", chunk_rows),
                     [Scan("__max", "max", F.col(field)), *[Scan(f"__first_{c}", "first", F.col(c)) for c in others]])
    return out.select(F.col("seq").alias("input_seq"), F.col(key), *[F.col(f"__first_{c}").alias(c) for c in others],
                      F.col("__max").alias(field))


def rolling_reduce(df: DataFrame, key: str = "id", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """A5 / ST6 reduce: (id, timestamp of the latest record, max temperature)."""
    out = keyed_scan(df, [key], ["seq"], seq_chunks("seq", chunk_rows),
                     [Scan("__max", "max", F.col("temperature"))])
    return out.select(F.col("seq").alias("input_seq"), F.col(key), F.col("timestamp"),
                      F.col("__max").alias("temperature"))


def rolling_max_final(df: DataFrame, key: str = "id", field: str = "temperature") -> DataFrame:
    """Final form of A3-A5: one row per key, the record a bounded run ends at."""
    best = F.struct(F.col(field).alias("v"), (-F.col("seq")).alias("neg_seq"),
                    F.struct(*[F.col(c) for c in df.columns]).alias("r"))
    return df.groupBy(key).agg(F.max(best).alias("__b")).select(
        *[F.col("__b.r").getField(c).alias(c) for c in df.columns])


# ---- A6-A9 window aggregates ---------------------------------------------

def window_min_by(df: DataFrame, size: str, key: str = "id", field: str = "temperature",
                  time_col: str = "timestamp", slide: str | None = None) -> DataFrame:
    """A6 ``timeWindow(size).minBy(field)``: whole record, first tie. The tie
    needs (field, seq) compared together, which Spark buffers as a struct:
    map tasks sort before the partial aggregate, and one record per group
    and task is shuffled."""
    w = window_columns(df, time_col, size, slide)
    rec = F.struct(F.col(field).alias("v"), F.col("seq").alias("s"),
                   F.struct(*[F.col(c) for c in df.columns]).alias("r"))
    return (w.groupBy("window_start", "window_end", key).agg(F.min(rec).alias("__m"))
            .select("window_start", "window_end",
                    *[F.col("__m.r").getField(c).alias(c) for c in df.columns]))


def window_sum(df: DataFrame, size: str, key: str = "id", field: str = "temperature",
               time_col: str = "timestamp", slide: str | None = None, scale: int | None = None) -> DataFrame:
    """A7 ``timeWindow(size).sum(field)``, summed once per pane."""
    v, name = F.col(field), f"sum_{field}"
    parts = {name: (F.sum(v if scale is None else v.cast(f"decimal(18,{scale})")), F.sum)}
    out = sliding_aggregate(df, key, size, slide, time_col, parts)
    return out if scale is None else out.withColumn(name, F.col(name).cast("double"))


def window_count(df: DataFrame, size: str, key: str, time_col: str = "timestamp",
                 slide: str | None = None, unit: str = "ms") -> DataFrame:
    """A8 incremental count per (window, key), once per pane; Catalyst's partial/merge/final
    aggregation is the reference's create/add/merge/getResult."""
    return sliding_aggregate(df, key, size, slide, time_col, {"count": (F.count(F.lit(1)), F.sum)}, unit)


def window_distinct_buckets(df: DataFrame, size: str, key: str, time_col: str = "timestamp",
                            slide: str | None = None, bucket: int = 1000, unit: str = "s") -> DataFrame:
    """Distinct ``timestamp / bucket`` values per (window, key)."""
    return sliding_distinct(df, key, size, slide, time_col, F.expr(f"`{time_col}` div {int(bucket)}"), unit=unit)


def distinct_per_bucket(df: DataFrame, who: str = "userId", time_col: str = "timestamp",
                        bucket_s: int = 86_400) -> DataFrame:
    """A10 (re-aimed, D6): distinct users per day (``bucket_s`` seconds)."""
    b = F.expr(f"(`{time_col}` div {int(bucket_s)}) * {int(bucket_s)}")
    return df.groupBy(b.alias("bucket_start")).agg(F.count_distinct(who).alias("users"))


def rollup_counts(counts: DataFrame, key: str, size_ms: int, count_col: str = "count",
                  start_col: str = "window_start") -> DataFrame:
    """A11 accumulator merge: fine window counts summed into coarser windows
    of ``size_ms`` (a multiple of the fine size)."""
    start = F.expr(f"`{start_col}` - pmod(`{start_col}`, {int(size_ms)})")
    return (counts.groupBy(start.alias("window_start"), key)
            .agg(F.sum(count_col).alias("count"))
            .withColumn("window_end", F.col("window_start") + F.lit(size_ms)))
