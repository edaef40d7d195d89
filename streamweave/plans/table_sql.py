"""E5 table API and SQL on a stream: parse sensor lines, project, filter,
and run SQL text on a registered view; the same code serves a bounded
table and a stream (append mode). Fields, predicates and SQL are the
caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from streamweave.operators.transforms import project, sql_on_view, where
from streamweave.sources.text import parse_sensor


def table_api(readings: DataFrame, fields: str, predicate: str | Column) -> DataFrame:
    """``table.select(fields).where(predicate)``."""
    return where(project(readings, fields), predicate)


def sql_api(spark: SparkSession, readings: DataFrame, view: str, query: str) -> DataFrame:
    return sql_on_view(spark, readings, view, query)


def from_lines(lines: DataFrame) -> DataFrame:
    return parse_sensor(lines)
