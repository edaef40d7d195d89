"""Sliding windows by panes: overlapping windows share their work.

A pane is gcd(size, slide) long, so every window is a whole number of panes.
Rows are aggregated once per (key, pane), map-side first; what is shuffled is
one row per (key, pane) and task, whatever size / slide is. Pane rows are
then dealt by key, copied to the windows that hold them inside the task, and
combined there: no raw row is copied and no window row is shuffled. A hot
key has as many pane rows as it has panes, so its task is bounded by time.
"""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from streamweave.functions.time import duration_ms


def pane_start(time_col: str, size: str, slide: str | None, unit: str = "ms") -> Column:
    """The start, in epoch ms, of the pane that holds a row's event time."""
    pane = gcd(duration_ms(size), duration_ms(slide or size))
    ms = F.col(time_col).cast("bigint") * (1 if unit == "ms" else 1000)
    return ms - F.pmod(ms, F.lit(pane))


def window_starts(pane: Column, size: str, slide: str | None) -> Column:
    """The starts of the windows that hold a pane (none if it lies between windows)."""
    n, step = duration_ms(size), duration_ms(slide or size)
    last, first = pane - F.pmod(pane, F.lit(step)), pane - F.lit(n - 1)
    return F.when(last >= first, F.sequence(last, first, F.lit(-step)))


def pane_windows(panes: DataFrame, key: str, size: str, slide: str | None, merge: list[Column], pane: str = "pane") -> DataFrame:
    """Combines rows of (key, pane) into (window_start, window_end, key, merged columns).

    Where a window is one pane there may still be several rows for it (distinct members)."""
    dealt = panes.repartition(F.col(key))
    copies = dealt.withColumn("window_start", F.explode(window_starts(F.col(pane), size, slide)))
    out = copies.groupBy("window_start", key).agg(*merge)
    rest = [c for c in out.columns if c not in ("window_start", key)]
    return out.select("window_start", (F.col("window_start") + F.lit(duration_ms(size))).alias("window_end"), key, *rest)


def sliding_aggregate(df: DataFrame, key: str, size: str, slide: str | None, time_col: str,
                      parts: dict[str, tuple[Column, Callable[[Column], Column]]], unit: str = "ms") -> DataFrame:
    """(window_start, window_end, key, names) of ``parts``: name -> (aggregate of a pane's rows, function that
    combines the panes' values), such as ``count: (F.count("*"), F.sum)``. Rows without a time are in no window."""
    df = df.where(F.col(time_col).isNotNull())
    panes = df.groupBy(key, pane_start(time_col, size, slide, unit).alias("pane")).agg(
        *(own.alias(name) for name, (own, _) in parts.items()))
    if slide is None or duration_ms(slide) == duration_ms(size):
        end = (F.col("pane") + F.lit(duration_ms(size))).alias("window_end")
        return panes.select(F.col("pane").alias("window_start"), end, key, *parts)
    return pane_windows(panes, key, size, slide, [merge(F.col(name)).alias(name) for name, (_, merge) in parts.items()])


def sliding_distinct(df: DataFrame, key: str, size: str, slide: str | None, time_col: str, member: Column,
                     name: str = "count", unit: str = "ms") -> DataFrame:
    """(window_start, window_end, key, name): distinct members per window; each pane sends a member once."""
    df = df.where(F.col(time_col).isNotNull())
    panes = df.select(key, pane_start(time_col, size, slide, unit).alias("pane"), member.alias("__member")).distinct()
    return pane_windows(panes, key, size, slide, [F.count_distinct("__member").alias(name)])
