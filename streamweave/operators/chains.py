"""Chains of windows without a sequential walk: parallel list ranking by pointer doubling.

A greedy window machine opens a window at a run's first row, lets the rows
of the next ``width`` ms join it, and opens the next window at the first row
after it. Which rows open a window depends on the one before, all along the
run; a walk would put a run into one task. Instead every row points to the
row that would open the next window if it opened one itself. A chunked
scan in falling time order finds these pointers; then, in rounds, every row
known to open a window marks the row that it points to, and joins square
the pointers (1, 2, 4, ... windows ahead). That is two joins for each doubling
of the longest chain, on (run, time), so one run's rows are spread over all
tasks.

Runs that fit into one window, nearly all in practice, need no pointers: one
aggregate answers them. Runs of at most SHORT rows are folded as one array each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from streamweave.operators.scan import Scan, keyed_scan, restored, surrogates
from streamweave.session import scratch, stored

#: Rows of a run that one expression may fold.
SHORT = 512


def folded(rows: DataFrame, width: int) -> DataFrame:
    """(__id, first, last, total, end, stop) of runs of few rows: the windows of a sorted array, opened one after another.

    ``rows`` carry their run's last time and the time of its end mark, ``last`` and ``stop``."""
    each = F.sort_array(F.collect_list(F.struct("__t", F.col("__n").cast("bigint").alias("__n"))))
    window = lambda first, last, total: F.struct(first.alias("first"), last.alias("last"), total.alias("total"))
    closed = lambda s: F.array_append(s["closed"], s["open"])
    state = lambda done, o: F.struct(done.alias("closed"), o.alias("open"))
    x = F.col("x")
    none = F.array().cast("array<struct<first:bigint,last:bigint,total:bigint>>")
    begun = state(none, window(x[0]["__t"], x[0]["__t"], x[0]["__n"]))

    def step(s, y):
        o = s["open"]
        joins = y["__t"] <= o["first"] + F.lit(width)
        return F.when(joins, state(s["closed"], window(o["first"], y["__t"], o["total"] + y["__n"]))).otherwise(
            state(closed(s), window(y["__t"], y["__t"], y["__n"])))

    found = F.aggregate(F.slice("x", 2, SHORT), begun, step, closed)
    out = rows.groupBy("__id").agg(each.alias("x"), F.max("last").alias("end"), F.max("stop").alias("stop"))
    out = out.select("__id", "end", "stop", F.explode(found).alias("w"))
    return out.select("__id", "w.first", "w.last", "w.total", "end", "stop")


def pointers(rows: DataFrame, width: int, chunk: int) -> DataFrame:
    """(__id, __at, __to): for each row, the run's first row later than ``__at`` + width, or null."""
    none = F.lit(None).cast("bigint")
    asked = rows.select("__id", (-(F.col("__t") + F.lit(width + 1))).alias("__o"), F.lit(1).alias("__kind"),
                        F.col("__t").alias("__at"), none.alias("__seen"))
    seen = rows.select("__id", (-F.col("__t")).alias("__o"), F.lit(0).alias("__kind"), none.alias("__at"),
                       F.col("__t").alias("__seen"))
    found = keyed_scan(asked.union(seen), ["__id"], ["__o", "__kind"], F.expr(f"__o div {int(chunk)}"),
                       [Scan("__to", "min", F.col("__seen"))])
    return found.where("__kind = 1").select("__id", "__at", "__to")


def reached(nodes: DataFrame, folder: str) -> DataFrame:
    """(__id, __at): the marked nodes and all that their chains of pointers meet.

    ``nodes``: (__id, __at, __to, __marked), one marked node at most for each
    __id; __to is null or another node's later place. In round k pointers lead
    2^k links ahead and the first 2^k nodes of a chain are marked: each marked
    node marks the one it points to, then all pointers are squared. A round is
    one written table, whose writing also counts the marks still to be passed
    on; a lost executor repeats one round."""
    key, waiting = ["__id", "__at"], F.col("__marked") & F.col("__to").isNotNull()
    for k in range(64):
        left = Observation()
        nodes = stored(nodes.observe(left, F.count(F.when(waiting, 1)).alias("n")), folder, f"round-{k}")
        if not left.get["n"]:
            return nodes.where("__marked").select(*key)
        linked = nodes.where(F.col("__to").isNotNull())
        ahead = nodes.select("__id", F.col("__at").alias("__to"), F.col("__to").alias("__far"))
        squared = linked.join(ahead, ["__id", "__to"]).select(*key, F.col("__far").alias("__to"), "__marked")
        squared = squared.union(nodes.where(F.col("__to").isNull()).select(squared.columns))
        met = nodes.where(waiting).select("__id", F.col("__to").alias("__at"), F.lit(True).alias("__met"))
        nodes = squared.join(met, key, "left").select(*key, "__to", (F.col("__marked") | F.col("__met").isNotNull()).alias("__marked"))
    raise RuntimeError("pointers do not lead forwards")


def greedy_windows(rows: DataFrame, key: str, width: int, chunk: int) -> DataFrame:
    """(key, first, last, total) of the windows of each run.

    ``rows``: (key, __run, __t, __n, __end), times unique per run but for its
    end mark. The first row of a run opens [t, t + width]; ``total`` adds up
    __n in it; a window that holds the run's end mark (__end, at most one,
    after all other rows) is cancelled. Windows left open at the end of the
    input count. ``chunk``: the width, in units of __t, of a scan's chunk.
    Rows are written to the shared folder once; the result is a plan over
    stored tables."""
    folder = scratch(rows.sparkSession)
    flat, part = surrogates(rows, [key])
    flat = flat.select(F.struct(*part, "__run").alias("__id"), "__t", "__n", "__end")
    flat = stored(flat, folder, "rows")
    body, t = ~F.col("__end"), F.col("__t")
    runs = flat.groupBy("__id").agg(
        F.min(F.when(body, t)).alias("first"), F.max(F.when(body, t)).alias("last"),
        F.sum(F.when(body, F.col("__n"))).alias("total"), F.max(F.when(~body, t)).alias("stop"),
        F.count(F.when(body, 1)).alias("n"))
    fits, many = F.col("last") - F.col("first") <= width, F.col("n") > SHORT
    some = Observation()
    runs = stored(runs.observe(some, F.count(F.when(~fits & many, 1)).alias("n")), folder, "runs")
    inside = flat.where(body).join(runs.where(~fits), "__id")
    windows = folded(inside.where(~many), width)
    if some.get["n"]:
        inside = stored(inside.where(many), folder, "inside")
        heads = inside.select("__id", F.col("__t").alias("__at"), (F.col("__t") == F.col("first")).alias("__marked"))
        nodes = pointers(inside, width, chunk).join(heads, ["__id", "__at"])
        marks = reached(nodes, folder).select("__id", F.col("__at").alias("__t"), F.col("__at").alias("__open"))
        inside = inside.select("__id", "__t", "__n", "last", "stop").join(marks, ["__id", "__t"], "left")
        owned = keyed_scan(inside, ["__id"], ["__t"], F.expr(f"__t div {int(chunk)}"), [Scan("__first", "max", F.col("__open"))])
        windows = windows.union(owned.groupBy("__id", "__first").agg(F.max("__t"), F.sum("__n"), F.max("last"), F.max("stop")))
    # Only the run's last window can hold its end mark.
    windows = windows.withColumn("stop", F.when(F.col("last") == F.col("end"), F.col("stop")))
    columns = ["__id", "first", "last", "total", "stop"]
    found = runs.where(fits).select(columns).union(windows.select(columns))
    found = found.where(F.col("stop").isNull() | (F.col("stop") > F.col("first") + F.lit(width)))
    fields = found.select(*(F.col("__id").getField(p).alias(p) for p in part), "first", "last", "total")
    return fields.select(restored(rows, key, part).alias(key), "first", "last", "total")
