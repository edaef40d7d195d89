"""Projections, filters, routing and SQL.

All of these are narrow: no shuffle, fully inside whole-stage codegen, and
the same code runs on a batch or a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamweave.functions.text import java_length, java_split_words, sensor_text
from streamweave.functions.time import event_time_from_ms, event_time_from_seconds


def line_length(df: DataFrame, col: str = "value") -> DataFrame:
    """P1 ``map(String::length)``; Java counts UTF-16 units."""
    return df.select(*[c for c in df.columns if c != col], java_length(F.col(col)).alias("length"))


def split_words(df: DataFrame, col: str = "value", keep: Sequence[str] = ("seq",)) -> DataFrame:
    """P2 flatMap: one row per word (Java ``split(" ")``), with word position."""
    kept = [c for c in keep if c in df.columns]
    return df.select(*kept, F.posexplode(java_split_words(F.col(col))).alias("pos", "word"))


def starts_with(df: DataFrame, prefix: str, col: str = "value") -> DataFrame:
    """P3 filter on a prefix (pushed to the Parquet scan as StringStartsWith)."""
    return df.where(F.col(col).startswith(prefix))


def field_equals(df: DataFrame, col: str, value) -> DataFrame:
    """P4 filter on equality of one field."""
    return df.where(F.col(col) == F.lit(value))


def project(df: DataFrame, fields: str | Sequence[str]) -> DataFrame:
    """P5 ``table.select("id,temperature")``."""
    names = [f.strip() for f in fields.split(",")] if isinstance(fields, str) else list(fields)
    return df.select(*names)


def where(df: DataFrame, predicate: str | Column) -> DataFrame:
    """P6 ``where`` / ``filter`` with an expression string or a Column."""
    return df.where(predicate)


def sql_on_view(spark: SparkSession, df: DataFrame, view: str, query: str) -> DataFrame:
    """P7 register a view and run SQL text over it."""
    df.createOrReplaceTempView(view)
    return spark.sql(query)


def split_branches(df: DataFrame, rules: Sequence[tuple[str, Column]], otherwise: str | None = None,
                   col: str = "branches") -> DataFrame:
    """P8 ``split(OutputSelector)``: tag each row with the names of its branches.

    ``rules`` are (name, predicate); a row gets every name whose predicate
    holds (an OutputSelector may return several); ``otherwise`` names the
    branch of rows no rule takes. Nulls never satisfy a rule.
    """
    tags = [F.when(F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in rules]
    arr = F.filter(F.array(*tags), lambda x: x.isNotNull())
    if otherwise is not None:
        arr = F.when(F.size(arr) == 0, F.array(F.lit(otherwise))).otherwise(arr)
    return df.withColumn(col, arr)


def select_branches(df: DataFrame, names: Sequence[str], col: str = "branches") -> DataFrame:
    """P9 ``select("high", "lower")``: rows in any chosen branch, each once."""
    return df.where(F.arrays_overlap(F.col(col), F.array(*[F.lit(n) for n in names]))).drop(col)


def high_low(df: DataFrame, threshold: float = 4.0, col: str = "temperature") -> DataFrame:
    """The reference's split: > threshold is ``high``, everything else ``lower``."""
    return split_branches(df, [("high", F.col(col) > F.lit(threshold))], otherwise="lower")


def side_output(df: DataFrame, main: Column) -> tuple[DataFrame, DataFrame]:
    """P10 ``process`` + ``ctx.output(tag)``: (main rows, side rows).

    The side output is the exact complement, rows where ``main`` is null
    included. Cache or persist the parent when both are written.
    """
    cond = F.coalesce(main, F.lit(False))
    return df.where(cond), df.where(~cond)


def tag_side_output(df: DataFrame, main: Column, col: str = "output") -> DataFrame:
    """P10 as one DataFrame: ``output`` = 'main' | 'side' (one pass, no split)."""
    return df.withColumn(col, F.when(F.coalesce(main, F.lit(False)), F.lit("main")).otherwise(F.lit("side")))


def connect_map(left: DataFrame, right: DataFrame,
                map1: Callable[[DataFrame], DataFrame], map2: Callable[[DataFrame], DataFrame],
                tag: str | None = "stream") -> DataFrame:
    """P11 ``connect().map(map1, map2)``: each side mapped to one common type.

    ``tag`` adds the side (1 or 2) so the result keeps where rows came from.
    """
    a, b = map1(left), map2(right)
    if tag:
        a, b = a.withColumn(tag, F.lit(1)), b.withColumn(tag, F.lit(2))
    return a.unionByName(b)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """P12 ``union``: bag semantics, never distinct."""
    out = first
    for o in others:
        out = out.unionByName(o)
    return out


def sensor_to_text(df: DataFrame) -> DataFrame:
    """P13 record -> text, ``SensorReading(id=…, timestamp=…, temperature=…)``."""
    keep = [c for c in ("seq",) if c in df.columns]
    return df.select(*keep, sensor_text(F.col("id"), F.col("timestamp"), F.col("temperature")).alias("value"))


def with_event_time(df: DataFrame, col: str = "timestamp", unit: str = "ms",
                    out: str = "event_time") -> DataFrame:
    """P14 ``ts * 1000L``: epoch seconds or ms -> TIMESTAMP event-time column."""
    conv = event_time_from_ms if unit == "ms" else event_time_from_seconds
    return df.withColumn(out, conv(F.col(col)))
