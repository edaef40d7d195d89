"""U5 user function surface, re-expressed on Spark's vectorized Python APIs.

The reference passes Java objects (Map, FlatMap, Filter, Reduce, Aggregate,
Window and Process functions). Prefer column expressions; when a user
function is genuinely Python, these wrap it in Arrow-batched forms, never
row-at-a-time UDFs:

* ``map_column``   Map over one column: a pandas Series -> Series UDF;
* ``filter_rows``  Filter with a vectorized predicate (Series -> bool Series);
* ``flat_map``     FlatMap: each row -> 0..n rows via ``mapInPandas``;
* ``aggregate``    Reduce/Aggregate per key: a key's rows become a state for
                   each share of the input, then states are merged by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType


def map_column(fn: Callable[[pd.Series], pd.Series], return_type: str) -> Callable[[Column], Column]:
    udf = F.pandas_udf(fn, return_type)
    return lambda c: udf(c)


def filter_rows(df: DataFrame, col: str, predicate: Callable[[pd.Series], pd.Series]) -> DataFrame:
    keep = F.pandas_udf(predicate, "boolean")
    return df.where(keep(F.col(col)))


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` maps one Arrow batch (pandas) to any number of output rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = fn(b)
            if len(out):
                yield out

    return df.mapInPandas(run, schema)


#: Keys whose states a task holds at once; states of one key that wait for a merge.
MOST_KEYS, WAITING = 65_536, 16
#: A task's rows and neighbouring tasks that send a key's rows to one place.
SHARE_ROWS, SHARE_TASKS = 1 << 22, 4


def state_schema(df: DataFrame, key: str, state_type: str, name: str = "state") -> StructType:
    return StructType([StructField("key", df.schema[key].dataType), *StructType.fromDDL(f"{name} {state_type}").fields])


def partial_states(df: DataFrame, key: str, col: str, partial: Callable[[pd.Series], object],
                   merge: Callable[[pd.Series], object], state_type: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """(key, state): one row per task and key; a task with more than ``most_keys`` keys sends what it holds and goes on.

    Each Arrow batch is cut by key, each piece becomes a state by ``partial``, and states of a key that pile up are
    merged, so a task's memory is bounded by its number of keys, not of rows."""
    schema = state_schema(df, key, state_type)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush():
            states = [s[0] if len(s) == 1 else merge(pd.Series(s)) for s in held.values()]
            out = pa.RecordBatch.from_arrays([pa.array(list(held), arrow.field(0).type), pa.array(states, arrow.field(1).type)],
                                             schema=arrow)
            held.clear()
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).dictionary_encode(null_encoding="encode")
            codes = keys.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            values = batch.column(1).take(pa.array(order)).to_pandas()
            array, kind = values.array, values.dtype
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            names = keys.dictionary.to_pylist()
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(codes)]):
                waiting = held.setdefault(names[codes[order[a]]], [])
                waiting.append(partial(pd.Series(array[a:b], dtype=kind)))
                if len(waiting) > WAITING:
                    waiting[:] = [merge(pd.Series(waiting))]
            if len(held) > most_keys:
                yield flush()
        if held:
            yield flush()

    return df.select(F.col(key).alias("key"), F.col(col).alias("value")).mapInArrow(run, schema)


def gathered(df: DataFrame, key: str, col: str) -> DataFrame:
    """(key, value) with the rows of a key next to each other, from shares of the input: SHARE_TASKS tasks, SHARE_ROWS rows of each.

    A key's rows of one share meet in one task, so a call sees many of them; a hot key is split into as many groups as
    the input has shares. However few files or row groups the input has, all cores take part."""
    share = F.struct(F.floor(F.spark_partition_id() / SHARE_TASKS).alias("tasks"),
                     F.floor((F.monotonically_increasing_id() % (1 << 33)) / SHARE_ROWS).alias("rows"))
    rows = df.select(F.col(key).alias("key"), F.col(col).alias("value"), share.alias("share"))
    return rows.repartition("key", "share").sortWithinPartitions("key").drop("share")


def aggregate(df: DataFrame, key: str, col: str, partial: Callable[[pd.Series], object],
              merge: Callable[[pd.Series], object], return_type: str, name: str = "value",
              state_type: str | None = None, result: Callable[[object], object] | None = None,
              most_keys: int = MOST_KEYS) -> DataFrame:
    """(key, name): Reduce/Aggregate per key with Python functions, the
    reference's create / add / merge / getResult:

    * ``partial(values) -> state``: the state of some of a key's values (create and add);
    * ``merge(states) -> state``: a Series of states of one key (dicts where
      ``state_type`` is a struct) into one;
    * ``result(state) -> value``; without it the state is the value, and
      ``state_type`` is ``return_type``.

    A key's rows are gathered by shares of the input (``gathered``) and become
    one state a share (``partial_states``), so Python is called for keys, not
    for rows, and a hot key is split into as many groups as there are shares,
    also if its rows are all equal; states of one key are then merged in order
    of arrival, WAITING at a time. Any split of the values must give
    the same result (max/max, sum/sum, count/sum). A null key is a key.
    Prefer built-in aggregates whenever they express the reduction.
    """
    states = partial_states(gathered(df, key, col), "key", "value", partial, merge, state_type or return_type, most_keys)
    out = state_schema(df, key, return_type, "value")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting = None, []

        def closed():
            state = waiting[0] if len(waiting) == 1 else merge(pd.Series(waiting))
            return last, state if result is None else result(state)

        for batch in batches:
            done = []
            for k, state in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if waiting and not (k == last or (k != k and last != last)):
                    done.append(closed())
                    waiting = []
                last = k
                waiting.append(state)
                if len(waiting) > WAITING:
                    waiting = [merge(pd.Series(waiting))]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done), arrow)], schema=arrow)
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(closed(), arrow)], schema=arrow)

    merged = states.repartition("key").sortWithinPartitions("key").mapInArrow(run, out)
    return merged.select(F.col("key").alias(key), F.col("value").alias(name))
