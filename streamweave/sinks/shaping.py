"""Row shaping for external sinks (K2 Kafka, K5 document index) and the
console / memory sinks (K1, K8). Delivery to Kafka needs the Kafka
connector on the classpath; the rows and options are tested offline."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from streamweave.functions.text import sensor_text


def kafka_records(df: DataFrame) -> DataFrame:
    """K2: (key, value) with the record's text form as the value."""
    return df.select(F.col("id").alias("key"),
                     sensor_text(F.col("id"), F.col("timestamp"), F.col("temperature")).alias("value"))


def kafka_sink_options(brokers: str, topic: str, checkpoint: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "checkpointLocation": checkpoint}


def write_kafka_stream(df: DataFrame, brokers: str, topic: str, checkpoint: str):
    return kafka_records(df).writeStream.format("kafka").options(**kafka_sink_options(brokers, topic, checkpoint))


def document_rows(df: DataFrame, index: str = "sensor", doc_type: str = "readingdata") -> DataFrame:
    """K5: index, type and a string map {id, temp, ts} per reading."""
    src = F.create_map(F.lit("id"), F.col("id"), F.lit("temp"), F.col("temperature").cast("string"),
                       F.lit("ts"), F.col("timestamp").cast("string"))
    return df.select(F.lit(index).alias("index"), F.lit(doc_type).alias("type"), src.alias("source"))


def labeled(df: DataFrame, label: str | None) -> DataFrame:
    """K1 ``print("label")``: the label as a leading column."""
    return df if label is None else df.select(F.lit(label).alias("label"), *df.columns)


def console_stream(df: DataFrame, label: str | None = None, output_mode: str = "append"):
    """K1 / K8: append-mode console sink of a streaming DataFrame."""
    return labeled(df, label).writeStream.format("console").outputMode(output_mode).option("truncate", "false")


def memory_stream(df: DataFrame, name: str, output_mode: str = "append"):
    """K8 ``toAppendStream`` into an in-memory table (tests)."""
    return df.writeStream.format("memory").queryName(name).outputMode(output_mode)
