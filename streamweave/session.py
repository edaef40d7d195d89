"""SparkSession helpers.

Library code never creates a session on its own; callers pass one in.
``build_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Hot running frames and sorts spill instead of failing.
    "spark.sql.windowExec.buffer.spill.threshold": "1048576",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "streamweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Driver and executors must both see it, so there is no fallback to a
    machine's own temporary folder: an unset setting is an error (tests and
    the bench pass a folder of their own)."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
