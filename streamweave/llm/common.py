"""Helpers shared by the operators: shared-folder tables, batch readers, hashes, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of text that a Python worker holds at once when it works through an Arrow batch.
CHUNK_BYTES = 512 << 10
#: Rows of an Arrow batch; Spark's own 10,000 texts may be hundreds of MB.
BATCH_ROWS = 1_000


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master, where all tasks run in one process, may leave the setting out."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Lowers the session's rows per Arrow batch to BATCH_ROWS, for plans that send texts to Python."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)
    return df


def chunks(batches, text: int, most: int = CHUNK_BYTES):
    """Cuts Arrow batches by rows so that a piece holds about ``most`` bytes of the text column."""
    for batch in batches:
        size = max(1, batch.num_rows)
        step = max(1, int(size * most / max(most, batch.column(text).nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of a sequence of word hashes, one for each start."""
    n = len(words) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for j in range(k):
            out += mix(words[j:j + n] + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & (2 ** 64 - 1)))
    return mix(out)


def components(edges: DataFrame, folder: str, name: str, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the least node of the component.

    Large-star and small-star steps in turn until nothing changes; each step is a partial aggregation and a
    join that Spark can split, so a hub's neighbours never meet in one task. Only a count and a checksum reach
    the driver."""
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               folder, f"{name}-0")

    def seal(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last = seal(e)
    for i in range(1, rounds + 1):
        # The least neighbours are stored, so that both sides of each join are plain shuffles: Spark splits a hub's.
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
                       folder, f"{name}-{i}m")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), folder, f"{name}-{i}l")
        small = stored(large.groupBy("a").agg(F.min("b").alias("m")), folder, f"{name}-{i}n")
        e = stored(large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .union(small.select("a", F.col("m").alias("b"))).distinct(), folder, f"{name}-{i}s")
        now = seal(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
