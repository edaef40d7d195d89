"""Keyed running scans that do not put a hot key into one task.

The reference's keyed operators emit one result per input row, in arrival
order (a changelog). The direct Spark form,
``agg.over(Window.partitionBy(key).orderBy(seq))``, sends every row of a
key to one task; a key holding a third of the data makes that task hold a
third of the data.

``keyed_scan`` instead runs a two-level prefix scan:

1. rows are cut into chunks by a monotone function of the order (for
   arrival order ``seq div width``, so a (key, chunk) holds at most
   ``width`` rows); the in-chunk running value is a window over
   (key, chunk) -- one shuffle of the data;
2. a per-(key, chunk) summary is aggregated with map-side partial
   aggregation (its shuffle carries one row per (key, chunk) per task);
3. the exclusive prefix of the summaries over earlier chunks of the key is
   a window over the summary table (one row per non-empty (key, chunk));
4. the prefix is joined back on (key, chunk) by a sort-merge join that
   keeps the data's partitioning and order, and combined.

The result is exact for any associative aggregate. Keys may be null: the
window and join run on a struct of the keys, and rows with a null order
value go to a leading chunk, so no row is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_CHUNK_ROWS = 1 << 20


@dataclass(frozen=True)
class Scan:
    """One running output column.

    kind: ``count`` (rows so far, inclusive), ``sum``, ``max``, ``min``
    (running, inclusive; ``max_before`` is the max over strictly earlier
    rows; ``total_max`` is the max over the key's whole input, taken from
    the chunk summaries, never from one task's rows; max/min accept
    structs, so ``max`` of
    ``struct(value, -seq, payload)`` is a rolling maxBy that keeps the first
    tie), ``lag`` (previous row's value, ``default`` for the first row of
    the key) and ``first`` (value at the key's first row).
    """

    name: str
    kind: str
    expr: Column | None = None
    default: object = None


def seq_chunks(seq_col: str, width: int = DEFAULT_CHUNK_ROWS) -> Column:
    """Chunk id for arrival order: at most ``width`` seq values per chunk.

    For a dense seq (0, 1, 2, ...) that bounds a (key, chunk) to ``width``
    rows. ``div`` truncates, so the chunk id is monotone in seq, as the scan
    requires. In a longer order (documents, lines, words) the first column
    is chunked: ``width`` then counts documents."""
    return F.expr(f"`{seq_col}` div {int(width)}")


def order_chunks(order: list[str], width: int = DEFAULT_CHUNK_ROWS) -> Column | list[Column]:
    """Chunks of an arrival order: of one column (``seq``), or of the leading
    columns as they are with the last one cut (a topic's ``partition,
    offset``: a chunk holds ``width`` offsets of one partition)."""
    cut = seq_chunks(order[-1], width)
    return cut if len(order) == 1 else [*map(F.col, order[:-1]), cut]


def time_chunks(ms_col: str, width_ms: int) -> Column:
    """Chunk id for event-time order (a monotone bucket of epoch ms)."""
    return F.expr(f"`{ms_col}` div {int(width_ms)}")


_FLAT_DEFAULTS = {"string": "", "bigint": 0, "int": 0, "smallint": 0, "tinyint": 0, "double": 0.0,
                  "float": 0.0, "boolean": False}


def surrogates(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Non-null stand-ins for the keys, so null keys group and join like
    any other value. One primitive key: (coalesce(k, default), k is null),
    cheaper to hash and sort; otherwise one struct of the keys (struct
    equality treats null fields as equal)."""
    if not keys:
        return df, []
    if len(keys) == 1:
        dtype = df.schema[keys[0]].dataType.simpleString()
        if dtype in _FLAT_DEFAULTS:
            k = F.col(keys[0])
            out = (df.withColumn("__key", F.coalesce(k, F.lit(_FLAT_DEFAULTS[dtype]).cast(dtype)))
                     .withColumn("__knull", k.isNull()))
            return out, ["__key", "__knull"]
    return df.withColumn("__key", F.struct(*[F.col(k) for k in keys])), ["__key"]


def restored(df: DataFrame, key: str, part: list[str]) -> Column:
    """One key as it was, from its stand-ins ``part``."""
    return F.when(~F.col("__knull"), F.col("__key")) if "__knull" in part else F.col("__key").getField(key)


# Rows whose order value is null sort first in a window; they go to a
# leading chunk, so they are kept (never lost to a null join key).
_NULL_CHUNK = -(1 << 63)


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], chunk: Column | list[Column] | None,
               scans: list[Scan], carry: bool = False, one_pass: bool = False) -> DataFrame:
    """Append the running columns of ``scans`` to ``df`` (one row per input).

    ``order`` must be a total order within a key (end it with ``seq``), and
    ``chunk`` a monotone non-decreasing function of it; a list of columns is
    compared in order (see ``order_chunks``).

    ``carry=True`` keeps the (key, chunk) partition columns in the output;
    a following scan over the same keys and chunks passes ``chunk=None`` to
    reuse them, and Spark then sees that the rows are already partitioned
    by them: the second scan adds no shuffle of the data.

    ``one_pass=True`` (counts and sums) hashes the totals from the rows that
    were shuffled for the running values instead of making ``df`` twice. Use
    it when ``df`` is costly to make and holds no column but keys, order and
    summed ones: then both branches need the same columns and Spark reuses
    the exchange.
    """
    if chunk is None:
        base = df
        sk = ([] if not keys else ["__key", "__knull"] if "__knull" in df.columns else ["__key"])
        if "__chunk" not in df.columns or (keys and "__key" not in df.columns):
            raise ValueError("chunk=None needs the columns of a previous scan with carry=True")
    else:
        base, sk = surrogates(df, list(keys))
        base = base.withColumn("__chunk", F.struct(*chunk) if isinstance(chunk, list)
                               else F.coalesce(chunk, F.lit(_NULL_CHUNK)))
    part = sk + ["__chunk"]
    whole = {}
    if one_pass and "__knull" in sk:  # the key travels once, as its stand-in
        whole = {keys[0]: restored(df, keys[0], sk).alias(keys[0])}
        base = base.drop(keys[0])
    w_in = Window.partitionBy(*part).orderBy(*order)
    w_run = w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A single whole-number order column orders the summaries by itself:
    # primitive buffers, so the partial aggregate hashes instead of sorting.
    if len(order) == 1 and base.schema[order[0]].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        order_key = F.coalesce(F.col(order[0]).cast("bigint"), F.lit(_NULL_CHUNK))
    else:
        order_key = F.struct(*[F.col(c) for c in order])

    # In-chunk running values, and the per-(key, chunk) totals. The totals
    # come from ``base`` with map-side partial aggregation: their shuffle is
    # one row per (key, chunk) per task, and the second pass over ``base``
    # reads only the key, order and aggregated columns. (Aggregating the
    # windowed rows instead would shuffle every row twice: the two
    # branches prune different columns, so Spark cannot reuse the exchange.)
    inner = {}
    summary = []
    for s in scans:
        n = s.name
        if s.kind == "count":
            inner[n] = F.count(F.lit(1)).over(w_run)
            summary.append(F.count(F.lit(1)).alias(f"__t_{n}"))
        elif s.kind == "sum":
            inner[n] = F.sum(s.expr).over(w_run)
            summary.append(F.sum(s.expr).alias(f"__t_{n}"))
        elif s.kind in ("max", "min"):
            fn = F.max if s.kind == "max" else F.min
            inner[n] = fn(s.expr).over(w_run)
            summary.append(fn(s.expr).alias(f"__t_{n}"))
        elif s.kind == "max_before":
            inner[n] = F.max(s.expr).over(w_in.rowsBetween(Window.unboundedPreceding, -1))
            summary.append(F.max(s.expr).alias(f"__t_{n}"))
        elif s.kind == "lag":
            inner[n] = F.lag(F.struct(s.expr.alias("v")), 1).over(w_in)
            summary.append(F.max_by(s.expr, order_key).alias(f"__t_{n}"))
        elif s.kind == "first":
            summary.append(F.min_by(s.expr, order_key).alias(f"__t_{n}"))
        elif s.kind == "total_max":
            summary.append(F.max(s.expr).alias(f"__t_{n}"))
        else:
            raise ValueError(f"unknown scan kind {s.kind}")

    if one_pass:
        if any(s.kind not in ("count", "sum") for s in scans):
            raise ValueError("one_pass takes counts and sums")
        # Both branches read this one exchange: the totals are hashed from its rows, never sorted or windowed again.
        # The hash of the order columns is null only without rows; it keeps the branches' columns the same.
        base = base.repartition(*part)
        some = F.max(F.xxhash64(*order)).isNotNull()
        summary = [F.when(some, c).alias(f"__t_{s.name}") for s, c in zip(scans, summary)]
    windowed = base.select("*", *[c.alias(f"__i_{n}") for n, c in inner.items()])
    summ = base.groupBy(*part).agg(*summary)
    w_c = Window.partitionBy(*sk).orderBy("__chunk")
    before = w_c.rowsBetween(Window.unboundedPreceding, -1)
    prefix = []
    for s in scans:
        t = F.col(f"__t_{s.name}")
        if s.kind in ("count", "sum"):
            prefix.append(F.sum(t).over(before).alias(f"__p_{s.name}"))
        elif s.kind in ("max", "max_before"):
            prefix.append(F.max(t).over(before).alias(f"__p_{s.name}"))
        elif s.kind == "min":
            prefix.append(F.min(t).over(before).alias(f"__p_{s.name}"))
        elif s.kind == "lag":
            prefix.append(F.lag(F.struct(t.alias("v")), 1).over(w_c).alias(f"__p_{s.name}"))
        elif s.kind == "first":
            prefix.append(F.first(F.struct(t.alias("v"))).over(w_c.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                          .alias(f"__p_{s.name}"))
        elif s.kind == "total_max":
            prefix.append(F.max(t).over(w_c.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
                          .alias(f"__p_{s.name}"))
    summ = summ.select(*part, *prefix)

    # Sort-merge join: the windowed side is already partitioned and sorted
    # by (key, chunk), so only the summary moves; a broadcast would copy the
    # summary (which grows with keys x chunks) to every executor.
    joined = windowed.join(summ.hint("merge"), on=part, how="inner")
    out = []
    for s in scans:
        n = s.name
        p, i = F.col(f"__p_{n}"), F.col(f"__i_{n}") if n in inner else None
        if s.kind in ("count", "sum"):
            val = F.when(p.isNull(), i).when(i.isNull(), p).otherwise(p + i)
        elif s.kind in ("max", "max_before"):
            val = F.greatest(p, i)
        elif s.kind == "min":
            val = F.least(p, i)
        elif s.kind == "lag":
            got = F.coalesce(i, p)
            val = F.when(got.isNull(), F.lit(s.default)).otherwise(got.getField("v"))
        elif s.kind == "total_max":
            val = p
        else:  # first
            val = p.getField("v")
        out.append(val.alias(n))
    carried = part if (carry and chunk is not None) else []
    return joined.select(*[whole.get(c, F.col(c)) for c in df.columns], *carried, *out)
