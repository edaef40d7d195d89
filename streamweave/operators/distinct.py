"""Distinct counts that merge: sets of whole numbers as bitmap words.

A set is a table of words (group, word, bits): member v is bit v & 63 of word
v >> 6. Building a set is a ``bit_or`` per (group, word), merging two is a
``bit_or`` too, and its size is the sum of the words' bit counts; all three are
hash aggregates with a map-side combine, exact for every whole number
(negative ones too). A word costs a row, so members that lie apart cost as
much as a distinct row, and dense ones a sixty-fourth of it.

Sets per hour, stored once, give days, weeks and sliding windows by merging:
the rows are never read again. ``DistinctLog`` keeps such sets on the shared
folder, batch by batch.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamweave.functions.time import duration_ms
from streamweave.operators.panes import pane_start, window_starts


def word_sets(df: DataFrame, groups: list[Column | str], member: str) -> DataFrame:
    """(groups, word, bits) of the distinct values of the whole-number column ``member``; nulls are in no set."""
    v = F.col(member).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), v.bitwiseAND(F.lit(63)).cast("int"))
    return (df.where(v.isNotNull()).groupBy(*groups, F.shiftright(v, 6).alias("word"))
            .agg(F.bit_or(bit).alias("bits")))


def merged_sets(sets: DataFrame, groups: list[Column | str]) -> DataFrame:
    """The unions of sets that ``groups`` map to the same group."""
    return sets.groupBy(*groups, "word").agg(F.bit_or("bits").alias("bits"))


def set_sizes(sets: DataFrame, groups: list[str], name: str = "users") -> DataFrame:
    return sets.groupBy(*groups).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))


def pane_sets(df: DataFrame, member: str, pane: str, time_col: str = "timestamp", unit: str = "s") -> DataFrame:
    """(pane, word, bits): the members of each pane (epoch ms), such as an hour."""
    return word_sets(df.where(F.col(time_col).isNotNull()), [pane_start(time_col, pane, None, unit).alias("pane")], member)


def window_set_sizes(panes: DataFrame, pane: str, size: str, slide: str | None = None, name: str = "users") -> DataFrame:
    """(window_start, window_end, name): distinct members per window of stored pane sets, rows unread.

    size and slide are multiples of the panes' length."""
    if duration_ms(size) % duration_ms(pane) or duration_ms(slide or size) % duration_ms(pane):
        raise ValueError(f"windows of {size} by {slide or size} are no whole number of panes of {pane}")
    copies = panes.withColumn("window_start", F.explode(window_starts(F.col("pane"), size, slide)))
    sizes = set_sizes(merged_sets(copies, ["window_start"]), ["window_start"], name)
    return sizes.select("window_start", (F.col("window_start") + F.lit(duration_ms(size))).alias("window_end"), name)


class DistinctLog:
    """Pane sets on a shared folder: one sub-folder per batch, replaced if the batch comes again.

    ``append`` fits ``foreachBatch``. ``read`` merges all batches' sets of a
    pane; ``compact`` writes the sets of the batches up to one as a batch of its
    own, which then stands for them: readers take the newest compacted table
    and the batches after it, so a crash between two steps loses and doubles
    nothing (a union of sets may hold a batch twice)."""

    def __init__(self, folder: str, member: str, pane: str = "1 hour", time_col: str = "timestamp", unit: str = "s"):
        self.folder, self.member, self.pane, self.time_col, self.unit = folder.rstrip("/"), member, pane, time_col, unit

    def append(self, batch: DataFrame, batch_id: int) -> None:
        sets = pane_sets(batch, self.member, self.pane, self.time_col, self.unit)
        sets.write.mode("overwrite").parquet(f"{self.folder}/batch-{int(batch_id)}")

    def _tables(self, spark: SparkSession) -> dict[str, list[int]]:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out: dict[str, list[int]] = {"batch": [], "upto": []}
        for entry in fs.listStatus(path) if fs.exists(path) else []:
            m = re.fullmatch(r"(batch|upto)-(\d+)", entry.getPath().getName())
            done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
            if m and fs.exists(done):
                out[m[1]].append(int(m[2]))
        return out

    def _live(self, spark: SparkSession) -> list[str]:
        there = self._tables(spark)
        base = max(there["upto"], default=None)
        after = sorted(b for b in there["batch"] if base is None or b > base)
        return ([f"{self.folder}/upto-{base}"] if base is not None else []) + [f"{self.folder}/batch-{b}" for b in after]

    def read(self, spark: SparkSession) -> DataFrame:
        """(pane, word, bits), one row per word of a pane's set."""
        live = self._live(spark)
        schema = "pane bigint, word bigint, bits bigint"
        sets = spark.read.schema(schema).parquet(*live) if live else spark.createDataFrame([], schema)
        return merged_sets(sets, ["pane"])

    def compact(self, spark: SparkSession) -> None:
        """Writes the union of all batches so far as one table; batches stay until someone deletes them."""
        last = max(self._tables(spark)["batch"], default=None)
        if last is not None:
            self.read(spark).write.mode("overwrite").parquet(f"{self.folder}/upto-{last}")
