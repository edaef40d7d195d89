"""E1 hot items and E2 de-duplicated hot items (bounded forms).

read -> parse -> event time -> keep ``pv`` -> per-item sliding count ->
top n per window -> text. The projection reaches the Parquet scan; so does
the filter if the caller maps ``testdata.pageviews``, which filters the raw
column (a filter on the mapped ``behavior`` cannot be pushed). Counts are
made once per (item, pane) and shared by the windows that hold the pane; the
top-n is a two-phase WindowGroupLimit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streamweave.operators.aggregates import window_distinct_buckets
from streamweave.operators.topn import hot_items_text, hot_items_top_n
from streamweave.operators.windows import item_view_counts


def hot_items(behaviors: DataFrame, size: str = "5 hours", slide: str = "2 hours", n: int = 5,
              behavior: str = "pv") -> DataFrame:
    """E1 with a plain count: (windowEnd, rank, itemId, count)."""
    pv = behaviors.where(F.col("behavior") == behavior).select("itemId", "timestamp")
    return hot_items_top_n(item_view_counts(pv, size, slide), n)


def hot_items_distinct_seconds(behaviors: DataFrame, size: str = "5 hours", slide: str = "2 hours",
                               n: int = 5, bucket: int = 1000, behavior: str = "pv") -> DataFrame:
    """E1 as the job counts (A9, D5): distinct ``timestamp / 1000`` buckets."""
    pv = behaviors.where(F.col("behavior") == behavior).select("itemId", "timestamp")
    counts = window_distinct_buckets(pv, size, "itemId", slide=slide, bucket=bucket)
    return hot_items_top_n(counts.select("itemId", F.col("window_end").alias("windowEnd"), "count"), n)


def hot_items_lines(behaviors: DataFrame, **kw) -> DataFrame:
    """E1 text output: one ``windowEnd-itemId:count;…`` line per window."""
    return hot_items_text(hot_items(behaviors, **kw))


def dedup_hot_items(behaviors: DataFrame, size: str = "5 hours", slide: str = "2 hours", n: int = 5,
                    behavior: str = "pv") -> DataFrame:
    """As E1 with the (itemId, timestamp) de-duplicating filter first."""
    # The key is all that the counts need, so the first of each key is the key.
    first = behaviors.where(F.col("behavior") == behavior).select("itemId", "timestamp").distinct()
    return hot_items_top_n(item_view_counts(first, size, slide), n)
