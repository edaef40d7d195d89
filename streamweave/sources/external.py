"""S8 Kafka and S9 socket streams (connector shape only).

The Kafka connector is not on this PySpark's classpath and sockets need a
server, so these are built and their options unit-tested, not run here.
Offsets live in the query checkpoint (exactly once), not in the consumer
group; ``group.id`` is passed only for broker-side monitoring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_source_options(brokers: str, topic: str, starting_offsets: str = "earliest",
                         group_id: str | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": "true"}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_lines(spark: SparkSession, brokers: str, topic: str, starting_offsets: str = "earliest",
                group_id: str | None = None) -> DataFrame:
    """A Kafka topic of string records: (value, partition, seq). ``seq`` is
    the offset, the arrival order within a partition; keyed operators that
    need a total order use (partition, seq)."""
    raw = spark.readStream.format("kafka").options(
        **kafka_source_options(brokers, topic, starting_offsets, group_id)).load()
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.col("partition"), F.col("offset").alias("seq"))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``socketTextStream``: not fault tolerant; tests use file streams."""
    return spark.readStream.format("socket").option("host", host).option("port", str(port)).load()
