"""Partitioning and per-partition functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def with_subtask_index(df: DataFrame, key: str = "id") -> DataFrame:
    """U1 ``getIndexOfThisSubtask``: (key, index of the partition it is in)."""
    return df.select(F.col(key), F.spark_partition_id().alias("subtask"))


def key_placement(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """(key, subtasks, rows): after ``key_by`` with parallelism n, in how
    many subtasks each key's rows are (one), and how many there are."""
    placed = with_subtask_index(key_by(df, n, key), key)
    return placed.groupBy(key).agg(F.count_distinct("subtask").alias("subtasks"), F.count(F.lit(1)).alias("rows"))


def map_partitions_with_resource(df: DataFrame, open_fn: Callable[[], object],
                                 map_fn: Callable[[object, pd.DataFrame], pd.DataFrame],
                                 close_fn: Callable[[object], None], schema) -> DataFrame:
    """U1 ``RichMapFunction.open/map/close``: set up once per partition, map
    its Arrow batches, always close (also on failure)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        res = open_fn()
        try:
            for b in batches:
                yield map_fn(res, b)
        finally:
            close_fn(res)

    return df.mapInPandas(run, schema)


def sensor_number_partition(n: int, col: str = "id") -> Column:
    """The reference's partitioner: ``sensor_k`` -> k - 1, checked to be in
    [0, n) (an id out of range fails the job instead of wrapping)."""
    k = F.split(F.col(col), "_").getItem(1).cast("int") - 1
    return F.when((k >= 0) & (k < n), k).otherwise(
        F.raise_error(F.concat(F.lit("partition out of range for "), F.col(col))))


def partition_custom(df: DataFrame, n: int, partition: Column) -> DataFrame:
    """U2 ``partitionCustom``: each row to the partition ``partition`` names."""
    return df.withColumn("__pid", partition).repartitionById(n, "__pid").drop("__pid")


def shuffle(df: DataFrame, n: int) -> DataFrame:
    """U3 ``shuffle()``: round-robin redistribution."""
    return df.repartition(n)


def global_partition(df: DataFrame) -> DataFrame:
    """U4 ``global()``: everything in one partition. For small results only.
    A shuffle, so the work before it stays in as many tasks as it had."""
    return df.repartition(1)


def key_by(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """U6 ``keyBy`` with parallelism n: hash partitioning on the key."""
    return df.repartition(n, *keys)
