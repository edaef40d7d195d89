"""In-memory records and scalar elements, with their arrival order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, LongType, StructField, StructType


def from_collection(spark: SparkSession, records: Iterable[Sequence], schema: StructType) -> DataFrame:
    """``env.fromCollection``: typed rows plus ``seq`` (1-based list position)."""
    rows = [tuple(r) + (i,) for i, r in enumerate(records, start=1)]
    full = StructType(list(schema.fields) + [StructField("seq", LongType(), False)])
    return spark.createDataFrame(rows, full)


def from_elements(spark: SparkSession, values: Iterable, data_type: DataType) -> DataFrame:
    """``env.fromElements``: one ``value`` column plus ``seq``."""
    schema = StructType([StructField("value", data_type, True)])
    return from_collection(spark, [(v,) for v in values], schema)
