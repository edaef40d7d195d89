"""Order statistics per group by distributed selection.

A median has no small accumulator, but it needs no sorted group either. Small
groups are sorted as arrays of at most SHORT values; map tasks send SHORT + 1
values of a group at most, so a hot group isn't moved to find out that it is
large. Large groups are narrowed down: a histogram of BINS bins between
the least and the greatest value that may still hold the wanted rank is counted
map-side, the bin with the rank becomes the next range, and so on until a
range is one value. A round divides the range by BINS; rows of large groups
are read in each, and what is shuffled is one row per (group, bin) and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from streamweave.operators.windows import window_columns
from streamweave.session import scratch, stored

#: Values of a group that one array may hold; bins of a round's histogram.
SHORT, BINS = 1024, 1024


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """Rises with v; the range's ends have bins of their own, so every round parts them."""
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)  # halves: the range of two doubles may not be one
    inside = F.floor(F.when(F.isnan(share), 0.0).otherwise(share) * BINS)
    return F.when(v == lo, 0).when(v == hi, BINS + 1).otherwise(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), inside)) + 1)


def _narrowed(rows: DataFrame, ranges: DataFrame, folder: str) -> DataFrame:
    """(__id, target, n, lo): the values at 0-based ``rank`` of each (__id, target)."""
    done = ranges.limit(0).select("__id", "target", "n", "lo")
    for k in range(2200):  # doubles have 2^64 values: far fewer rounds are ever needed
        left = Observation()
        ranges = stored(ranges.observe(left, F.count(F.when(F.col("lo") < F.col("hi"), 1)).alias("n")), folder, f"range-{k}")
        done = done.union(ranges.where("lo = hi").select("__id", "target", "n", "lo"))
        if not left.get["n"]:
            return done
        wide = ranges.where("lo < hi")
        v = F.col("__v")
        inside = rows.join(wide, "__id").where((v >= F.col("lo")) & (v <= F.col("hi")))
        bins = inside.groupBy("__id", "target", "n", "rank", _bin(v, F.col("lo"), F.col("hi")).alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        upto = Window.partitionBy("__id", "target", "n", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("before", F.coalesce(F.sum("c").over(upto), F.lit(0)))
        ranges = bins.where("before <= rank and rank < before + c").select(
            "__id", "target", "n", (F.col("rank") - F.col("before")).alias("rank"), "lo", "hi")
    raise RuntimeError("ranges do not narrow")


def order_statistics(df: DataFrame, groups: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """(groups, n, q): q[i] is the value at ``fractions[i]`` of a group's n values, interpolated between
    neighbours (0.5: the median). Null and NaN values are left out; a group without others has no row. A null
    in ``groups`` is a group like any other. Large groups run jobs and are written to the shared folder."""
    folder = scratch(df.sparkSession)
    v = F.col(value).cast("double")
    flat = df.where(v.isNotNull() & ~F.isnan(v)).select(F.struct(*groups).alias("__id"), v.alias("__v"))
    first = flat.withColumn("rn", F.row_number().over(Window.partitionBy("__id").orderBy("__v"))).where(F.col("rn") <= SHORT + 1)
    heads = first.groupBy("__id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("__v")).alias("x"))

    def between(f: float, low: Column, high: Column, n: Column) -> Column:
        return low + (high - low) * (F.lit(f) * (n - 1) - F.floor(F.lit(f) * (n - 1)))

    n, x = F.col("n"), F.col("x")
    at = lambda f, up: (F.ceil if up else F.floor)(F.lit(f) * (n - 1))
    q = F.array(*(between(f, F.get(x, at(f, False).cast("int")), F.get(x, at(f, True).cast("int")), n) for f in fractions))
    many = Observation()
    heads = heads.select("__id", "n", F.when(n <= SHORT, q).alias("q"))
    heads = stored(heads.observe(many, F.count(F.when(n > SHORT, 1)).alias("n")), folder, "heads")
    out = heads.where("q is not null")
    if many.get["n"]:
        rows = stored(flat.join(heads.where("q is null").select("__id"), "__id", "left_semi"), folder, "rows")
        all_of = rows.groupBy("__id").agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
        wanted = F.posexplode(F.array(*(at(f, up) for f in fractions for up in (False, True))))
        found = _narrowed(rows, all_of.select("__id", "n", "lo", "hi", wanted.alias("target", "rank")), folder)
        of = lambda i: F.max(F.when(F.col("target") == i, F.col("lo")))
        found = found.groupBy("__id", "n").agg(*(of(i).alias(f"v{i}") for i in range(2 * len(fractions))))
        values = F.array(*(between(f, F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}"), n) for i, f in enumerate(fractions)))
        out = out.union(found.select("__id", "n", values.alias("q")))
    return out.select(*(F.col("__id").getField(g).alias(g) for g in groups), "n", "q")


def window_median(df: DataFrame, size: str, key: str = "id", field: str = "temperature", time_col: str = "timestamp",
                  slide: str | None = None) -> DataFrame:
    """(key, window_end, n, median_field) of each (window, key), whatever the size of a group."""
    w = window_columns(df.where(F.col(time_col).isNotNull()), time_col, size, slide).select("window_end", key, field)
    return order_statistics(w, [key, "window_end"], field, [0.5]).select(
        key, "window_end", "n", F.get("q", F.lit(0)).alias(f"median_{field}"))
