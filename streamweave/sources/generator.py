"""S10 generated readings: id ``senor_<int>``, a time, temperature in [0, 1).

Java's exact random sequence is not reproduced; the distribution is. The
batch form derives every value from the row number with seeded hashes, so
it is deterministic and splits over partitions; the stream form uses the
``rate`` source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SEED = 47  # fixed value: the reference's Random seed


def _fields(n_col, ts_col):
    rnd_int = F.hash(n_col, F.lit(SEED))
    rnd_dbl = (F.abs(F.xxhash64(n_col, F.lit(SEED + 1))) % F.lit(1 << 53)) / F.lit(float(1 << 53))
    return [F.concat(F.lit("senor_"), rnd_int.cast("string")).alias("id"), ts_col.alias("timestamp"),
            rnd_dbl.alias("temperature"), n_col.alias("seq")]


def generated_readings(spark: SparkSession, n: int, start_ms: int = 0, step_ms: int = 1) -> DataFrame:
    """Batch: ``n`` readings with timestamps start_ms + i * step_ms."""
    r = spark.range(n)
    return r.select(*_fields(F.col("id"), F.lit(start_ms) + F.col("id") * F.lit(step_ms)))


def generated_stream(spark: SparkSession, rows_per_second: int = 100) -> DataFrame:
    """Stream: endless readings from the ``rate`` source."""
    r = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    return r.select(*_fields(F.col("value"), F.unix_millis("timestamp")))
