"""Keyed sequential folds: the rising-temperature alert (ST10, D3) and the
login-failure warning (ST14, D7), and a generic keyed fold.

Both alerts are state machines per key over rows in (timestamp, seq) order.
Their rows are first reduced, JVM-side, to what can change the machine:

* rows of one (key, instant) become one row: for readings whether a fall came
  and whether a rise came after the last fall, for logins whether a success
  came and how many failures came after the last one;
* readings that neither fall nor rise go.

So what is left per key is bounded by time, not by data size. A fall (a
success) ends a run and is its end mark; run numbers come from a chunked
scan. Inside a run both machines open windows greedily: the first row opens
[t, t + width], rows in it join, the next row after it opens the next window,
and the end mark cancels the window it falls into. ``chains.greedy_windows``
finds the windows by pointer doubling, with JVM operators only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from streamweave.functions.time import duration_label, duration_ms
from streamweave.operators.chains import greedy_windows
from streamweave.operators.scan import Scan, keyed_scan, restored, surrogates, time_chunks

JAVA_DOUBLE_MIN_VALUE = 4.9e-324  # fixed value: Java's Double.MIN_VALUE, the initial "last" (D3)
DEFAULT_CHUNK_MS = 3_600_000
#: Chunk of the generic fold, which sees all rows: at most a second of a key's rows in one task.
FOLD_CHUNK_MS = 1_000


def _flag(c):
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def _segments(df: DataFrame, key: str, time_col: str, lag_expr, starts_here, ends_here,
              chunk_ms: int) -> DataFrame:
    """Segment id per row: the number of boundaries up to it, where row i
    starts a segment when ``starts_here(prev)`` holds for it or
    ``ends_here(prev)`` held for row i-1 (``prev`` is the lagged struct).

    seg_i = sum_{j<=i}(start_j + end_j) - end_i, so one running sum does it.
    """
    order = [time_col, "seq"]
    chunk = time_chunks(time_col, chunk_ms)
    s1 = keyed_scan(df, [key], order, chunk, [Scan("__prev", "lag", lag_expr)], carry=True)
    p = F.col("__prev")
    s1 = (s1.withColumn("__s", _flag(p.isNotNull() & starts_here(p)))
            .withColumn("__e", _flag(ends_here(p))))
    s2 = keyed_scan(s1, [key], order, None, [Scan("__cum", "sum", F.col("__s") + F.col("__e"))])
    return s2.withColumn("__seg", F.col("__cum") - F.col("__e"))


def _sorted_segments(df: DataFrame, key: str, time_col: str) -> DataFrame:
    return df.repartition(key, "__seg").sortWithinPartitions(key, "__seg", time_col, "seq")


class _OrderGuard:
    """Fails loudly if a segment's rows are not in (time, seq) order."""

    def __init__(self):
        self.last = None

    def check(self, group, t, s):
        cur = (group, t, s)
        if self.last is not None and self.last[0] == group and (t, s) < self.last[1:]:
            raise RuntimeError(f"fold input out of order in group {group!r}")
        self.last = cur


def keyed_fold(df: DataFrame, key: str, time_col: str, fields: list[str], lag_expr, starts_here, ends_here,
               step, finish, out_schema: str, out_cols: list[str], chunk_width: int = FOLD_CHUNK_MS,
               derive: dict | None = None) -> DataFrame:
    """Bounded keyed process function: run a state machine per key over rows
    in (time, seq) order, cut exactly at rows where it is in its initial
    state. For machines that need every row; the machine runs row by row in
    Python, and a run without such a cut is folded in one task (reduce rows
    first where the machine allows it, as the alerts below do).

    ``lag_expr`` is what a row needs of its predecessor. Segment boundaries
    are Column predicates over the row's columns and ``prev`` (its
    predecessor's lagged struct, null for a key's first row):
    ``starts_here(prev)`` -- the row starts a new segment; ``ends_here(prev)``
    -- the row is the last of its segment (the next row starts one); ``step(key, state, t, values, out)``
    returns the new state (None = initial) and appends output tuples to
    ``out``; ``finish(key, state, out)`` closes a segment (pending timers
    fire at the end of the input). ``derive`` adds columns computed from
    the lagged predecessor ``__prev`` (e.g. the previous value), usable in
    ``fields``.
    """
    seg = _segments(df, key, time_col, lag_expr, starts_here=starts_here, ends_here=ends_here,
                    chunk_ms=chunk_width)
    for name, col in (derive or {}).items():
        seg = seg.withColumn(name, col)
    names = [key, "__seg", time_col, "seq", *fields]
    rows = _sorted_segments(seg.select(*names), key, time_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        guard = _OrderGuard()
        group, state, out = None, None, []
        for b in batches:
            for k, sg, t, s, *vals in zip(*[b[c].tolist() for c in names]):
                g = (k, sg)
                if g != group:
                    if group is not None:
                        finish(group[0], state, out)
                    group, state = g, None
                guard.check(g, t, s)
                state = step(k, state, int(t), vals, out)
            if out:
                yield pd.DataFrame(out, columns=out_cols)
                out = []
        if group is not None:
            finish(group[0], state, out)
        if out:
            yield pd.DataFrame(out, columns=out_cols)

    return rows.mapInPandas(run, out_schema)


def _windows_of(numbered: DataFrame, key: str, width: int, chunk: int) -> DataFrame:
    """``greedy_windows`` over rows (key, __t, __ends, __opens, __run): ``__ends`` closes the run before it,
    ``__opens`` > 0 is what the row adds to the run that begins or goes on."""
    row = lambda run, n, end: F.struct(run.alias("run"), n.cast("bigint").alias("n"), F.lit(end).alias("end"))
    both = F.array(F.when(F.col("__ends"), row(F.col("__run") - 1, F.lit(0), True)),
                   F.when(F.col("__opens") > 0, row(F.col("__run"), F.col("__opens"), False)))
    out = numbered.select(key, "__t", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x"))
    return greedy_windows(out.select(key, F.col("x.run").alias("__run"), "__t", F.col("x.n").alias("__n"),
                                     F.col("x.end").alias("__end")), key, width, chunk)


def rising_alerts(df: DataFrame, interval: str = "10 seconds", key: str = "id", time_col: str = "timestamp",
                  field: str = "temperature", chunk_ms: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """ST10: per key, an alert at ``deadline`` when a rise armed a timer at
    t (deadline t + interval) and no fall came at or before it (D3).

    Output: (key, alert_time ms). The first reading arms iff temp > 0.
    Readings that are null or NaN, or have no time, take no part: the next
    one is compared with the last that has a value.

    Instants are compared with the one before, and falls are numbered, in one
    two-level pass: inside chunks of time, then over one row per chunk (its
    first and last reading, its falls), joined back. Both levels read the
    same shuffled columns, so the shuffle is made once.
    """
    n = duration_ms(interval)
    there = F.col(field).isNotNull() & ~F.isnan(F.col(field).cast("double")) & F.col(time_col).isNotNull()
    rows = df.where(there).select(key, F.col(time_col).alias("__t"), "seq", F.col(field).alias("__v"))
    before = F.lag("__v").over(Window.partitionBy(key, "__t").orderBy("seq"))
    rows = rows.select("*", (F.col("__v") < before).alias("__fall"), (F.col("__v") > before).alias("__rise"))
    instants = rows.groupBy(key, "__t").agg(
        F.min_by("__v", "seq").alias("__first"), F.max_by("__v", "seq").alias("__last"),
        F.max(F.when(F.col("__fall"), F.col("seq"))).alias("__f"),
        F.max(F.when(F.col("__rise"), F.col("seq"))).alias("__r"))
    instants, part = surrogates(instants, [key])
    # What an instant's own rows do after its first: 1 a fall, 2 a rise after the last fall or without one.
    own = (F.when(F.col("__f").isNull(), F.when(F.col("__r").isNotNull(), 2).otherwise(0))
           .otherwise(F.when(F.col("__r") > F.col("__f"), 3).otherwise(1)))
    instants = instants.select(*part, "__t", "__first", "__last", own.alias("__own"),
                               F.expr(f"__t div {int(chunk_ms)}").alias("__chunk"))
    in_chunk = Window.partitionBy(*part, "__chunk").orderBy("__t")
    start = F.lit(JAVA_DOUBLE_MIN_VALUE)
    seen = instants.withColumn("__head", F.lag("__t").over(in_chunk).isNull())
    seen = seen.withColumn("__prev", F.coalesce(F.lag("__last").over(in_chunk), start))
    fell = F.coalesce(F.col("__first") < F.col("__prev"), F.lit(False))
    inner = F.col("__own").bitwiseAND(1) == 1
    seen = seen.withColumn("__in", (inner | (~F.col("__head") & fell)).cast("int"))
    seen = seen.withColumn("__cum", F.sum("__in").over(in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    chunks = seen.groupBy(*part, "__chunk").agg(
        F.min_by("__first", "__t").alias("__cf"), F.max_by("__last", "__t").alias("__cl"), F.max("__cum").alias("__falls"),
        F.min_by("__in", "__t").alias("__headed"))
    along = Window.partitionBy(*part).orderBy("__chunk")
    chunks = chunks.withColumn("__before", F.coalesce(F.lag("__cl").over(along), start))
    # A chunk whose first reading is a fall from the chunk before, unless its first instant counts already.
    chunks = chunks.withColumn("__extra", (F.coalesce(F.col("__cf") < F.col("__before"), F.lit(False))
                                           & (F.col("__headed") == 0)).cast("int"))
    upto = along.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*part, "__chunk", "__before", "__extra",
                           F.coalesce(F.sum(F.col("__falls") + F.col("__extra")).over(upto), F.lit(0)).alias("__base"))
    out = seen.join(chunks.hint("merge"), [*part, "__chunk"])
    out = out.withColumn("__prev", F.when(F.col("__head"), F.col("__before")).otherwise(F.col("__prev")))
    rose = F.coalesce(F.col("__first") > F.col("__prev"), F.lit(False))
    late_rise = F.col("__own").bitwiseAND(2) == 2
    marks = out.select(restored(df, key, part).alias(key), "__t", (inner | fell).alias("__ends"),
                       (late_rise | (~inner & rose)).cast("int").alias("__opens"),
                       (F.col("__base") + F.col("__extra") + F.col("__cum")).alias("__run"))
    found = _windows_of(marks.where("__ends or __opens > 0"), key, n, chunk_ms)
    return found.select(key, (F.col("first") + F.lit(n)).alias("alert_time"))


def login_fail_warnings(df: DataFrame, window: str = "2 seconds", max_fails: int = 1, key: str = "userId",
                        time_col: str = "timestamp", state_col: str = "loginState",
                        chunk_width: int = 86_400) -> DataFrame:
    """ST14 (D7): the first failure opens [t, t + window]; later failures in
    it join; a success in it cancels; when it closes with >= ``max_fails``
    failures emit (userId, firstFailTime, lastFailTime, warningMsg).
    ``timestamp`` is in seconds, as in LoginEvent, and so is
    ``chunk_width`` (the scan chunk of the time column). Every state but
    ``fail`` counts as a success; events without a time take no part."""
    w_s = duration_ms(window) // 1000
    label = duration_label(window)
    ok = F.col("__ok")
    rows = df.where(F.col(time_col).isNotNull())
    rows = rows.select(key, F.col(time_col).alias("__t"), "seq", F.coalesce(F.col(state_col) != "fail", F.lit(True)).alias("__ok"))
    last_ok = F.max(F.when(ok, F.col("seq"))).over(Window.partitionBy(key, "__t"))
    rows = rows.select(key, "__t", "__ok", (~ok & F.coalesce(F.col("seq") > last_ok, F.lit(True))).alias("__fail"))
    marks = rows.groupBy(key, "__t").agg(F.bool_or("__ok").alias("__ends"), F.sum(F.col("__fail").cast("int")).alias("__n"))
    # Both in one column: the scan's two levels then need the same columns, and the shuffle is made once.
    marks = marks.select(key, "__t", (F.col("__n") * 2 + F.col("__ends").cast("int")).alias("__code"))
    ends = F.col("__code") % 2
    runs = keyed_scan(marks, [key], ["__t"], time_chunks("__t", chunk_width), [Scan("__run", "sum", ends)], one_pass=True)
    runs = runs.select(key, "__t", "__run", (ends == 1).alias("__ends"), F.expr("__code div 2").alias("__opens"))
    found = _windows_of(runs, key, w_s, chunk_width).where(F.col("total") >= max_fails)
    return found.select(key, F.col("first").alias("firstFailTime"), F.col("last").alias("lastFailTime"),
                        F.concat(F.lit(f"login fail in {label} for "), F.col("total").cast("string"),
                                 F.lit(" times")).alias("warningMsg"))
