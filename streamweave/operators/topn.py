"""Top-N per group (ST13) and its text form.

``row_number() <= n`` over a group is planned by Spark as a partial
WindowGroupLimit before the shuffle and a final one after it, so no
group moves more than n rows per map task, however hot the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
          rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= n)


def hot_items_top_n(counts: DataFrame, n: int = 5) -> DataFrame:
    """ST13 on ItemViewCount rows: per windowEnd the n items with the highest
    count, ties by itemId (D2). Columns: windowEnd, rank, itemId, count."""
    return top_n(counts, ["windowEnd"], [F.col("count").desc(), F.col("itemId").asc()], n) \
        .select("windowEnd", "rank", "itemId", "count")


def hot_items_text(ranked: DataFrame) -> DataFrame:
    """ST13 output line per window: ``windowEnd-itemId:count;`` in rank order.

    Collects only the n ranked rows of a window, a bounded list."""
    entry = F.concat(F.col("windowEnd").cast("string"), F.lit("-"), F.col("itemId").cast("string"),
                     F.lit(":"), F.col("count").cast("string"), F.lit(";"))
    parts = F.sort_array(F.collect_list(F.struct(F.col("rank"), entry.alias("t"))))
    return ranked.groupBy("windowEnd").agg(F.array_join(F.transform(parts, lambda x: x["t"]), "").alias("value"))
