"""Keyed and operator state in bounded form.

ST1 running count, ST2 count per key, ST4 list state (last n values), ST6 reducing
state (= A5), ST7 temperature jump alert, ST11 de-duplicating filter.
All running forms are chunked scans; de-duplication is a partial
aggregate. The streaming forms are in ``streamweave.streaming``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from streamweave.operators.scan import DEFAULT_CHUNK_ROWS, Scan, keyed_scan, order_chunks, seq_chunks


def running_count(df: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """ST1 operator state: the count of rows so far over the whole input
    (the sum of all subtasks' counts after restore). No one-partition
    window: per-chunk counts are prefixed over a table of one row per chunk."""
    return keyed_scan(df, [], ["seq"], seq_chunks("seq", chunk_rows), [Scan("count", "count")])


def count_per_key(df: DataFrame, key: str = "id", chunk_rows: int = DEFAULT_CHUNK_ROWS,
                  order: Sequence[str] = ("seq",)) -> DataFrame:
    """ST2 ValueState counter: per input, the count of its key so far.
    ``order``: the arrival order, e.g. (partition, offset) of a topic."""
    return keyed_scan(df, [key], list(order), order_chunks(list(order), chunk_rows), [Scan("count", "count")])


def counts_so_far(df: DataFrame, key: str = "id") -> DataFrame:
    """(key, count): what ``RunningCount`` has counted after a bounded input; a stream's initial state."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def last_readings(df: DataFrame, key: str = "id", field: str = "temperature") -> DataFrame:
    """(key, field): the last reading of each key by ``seq``; the initial state of a stream of ``JumpAlert``."""
    return df.groupBy(key).agg(F.max_by(field, "seq").alias(field))


def last_values(df: DataFrame, n: int = 3, key: str = "id", field: str = "temperature",
                block_rows: int = DEFAULT_CHUNK_ROWS, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """ST4 ListState: each element sees the list before its own add; the list
    keeps its last ``n`` values. Output: the row, ``values`` (oldest first)
    and ``list_size_before`` (how many the key has had so far).

    Rows are numbered per key, cut into blocks of ``block_rows`` with a halo
    of ``n`` rows from the block before, and each block builds its lists."""
    numbered = keyed_scan(df, [key], ["seq"], seq_chunks("seq", chunk_rows), [Scan("__rn", "count")])
    pos = F.expr(f"(__rn - 1) % {int(block_rows)}")
    copies = F.when(pos >= block_rows - n, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    blocks = (numbered.withColumn("__copy", F.explode(copies))
              .withColumn("__blk", F.expr(f"(__rn - 1) div {int(block_rows)}") + F.col("__copy")))
    w = Window.partitionBy(key, "__blk").orderBy("__rn").rowsBetween(-n, -1)
    return (blocks.withColumn("values", F.collect_list(field).over(w)).where("__copy = 0")
            .select(*df.columns, "values", (F.col("__rn") - 1).alias("list_size_before")))


def temperature_jumps(df: DataFrame, threshold: float = 10.0, key: str = "id", field: str = "temperature",
                      initial: float = 0.0, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """ST7 ``TempChangeWarning``: (id, lastTemp, temperature) when
    |current - last| >= threshold; last starts at ``initial`` (0.0)."""
    out = keyed_scan(df, [key], ["seq"], seq_chunks("seq", chunk_rows),
                     [Scan("lastTemp", "lag", F.col(field), default=initial)])
    return (out.where(F.abs(F.col(field) - F.col("lastTemp")) >= F.lit(threshold))
            .select(key, "lastTemp", F.col(field).alias("temperature"), "seq"))


_FIXED_WIDTH = ("bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz")


def dedup_first(df: DataFrame, keys: Sequence[str], order: str | Sequence[str] = "seq") -> DataFrame:
    """ST11 stateful de-duplicating filter: the first row (by ``order``) of
    each key passes. Partially aggregated map-side, so a hot key sends one
    row per map task. With one order column and fixed-width columns beside the
    keys the aggregate hashes (``min_by`` per column); other rows, or an order
    of several columns such as (partition, offset), are compared as structs,
    for which map tasks sort first."""
    order = [order] if isinstance(order, str) else list(order)
    types = dict(df.dtypes)
    rest = [c for c in df.columns if c not in order and c not in keys]
    if len(order) == 1 and all(types[c] in _FIXED_WIDTH for c in [*rest, *order]):
        first = [F.min(order[0]).alias(order[0])] + [F.min_by(c, order[0]).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*first).select(*df.columns)
    agg = F.min(F.struct(*order, *[c for c in df.columns if c not in order])).alias("__f")
    return (df.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(agg)
            .select(*[F.col("__f").getField(c).alias(c) for c in df.columns]))
