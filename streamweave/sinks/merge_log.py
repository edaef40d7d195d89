"""K3 keyed upsert sink as a bucketed merge log.

Rows lie under ``batch_id=<n>/bucket=<hash of the key>``: a level of a bucket is what one batch wrote to it. The newest
level that holds a key has its value. ``get`` opens the key's bucket alone. ``compact`` merges, in each bucket, its newest
levels as long as the next older one isn't much larger than they are together: a bucket that got no rows isn't touched,
and a large old level is rewritten only when as much has come on top of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamweave.session import scratch, stored

BUCKETS = 64
#: An older level joins a merge if it has at most so many times the bytes of the newer ones together.
TIER = 4


class MergeLog:
    """foreachBatch sink. A replayed batch replaces its own level; a null key is a key like others."""

    def __init__(self, path: str, key: str, value: str, order: str = "seq", buckets: int = BUCKETS):
        self.path, self.key, self.value, self.order, self.buckets = path.rstrip("/"), key, value, order, buckets

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _latest(self, rows: DataFrame, *order: str) -> DataFrame:
        last = F.max_by(F.struct(F.col(self.value).alias("v"), F.col(self.order).alias("o")), F.struct(*order))
        return (rows.groupBy(self.key).agg(last.alias("r"))
                .select(self.key, F.col("r.v").alias(self.value), F.col("r.o").alias(self.order)))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        latest = self._latest(batch, self.order).withColumn("bucket", self.bucket(F.col(self.key)))
        (latest.repartition("bucket").write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.path}/batch_id={int(batch_id)}"))

    __call__ = write_batch

    def levels(self, spark: SparkSession) -> dict[int, list[tuple[int, int]]]:
        """bucket -> (batch, bytes) of its levels, the newest first. One entry per folder reaches the driver."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = root.getFileSystem(spark._jsc.hadoopConfiguration())
        found: dict[int, list[tuple[int, int]]] = {}
        for own in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "batch_id=*/bucket=*")) or []:
            p = own.getPath()
            batch, bucket = (int(x.getName().split("=")[1]) for x in (p.getParent(), p))
            found.setdefault(bucket, []).append((batch, store.getContentSummary(p).getLength()))
        return {b: sorted(own, reverse=True) for b, own in found.items()}

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", self.path).parquet(f"{self.path}/batch_id=*")

    def read(self, spark: SparkSession) -> DataFrame:
        """(key, value), the newest of each key."""
        return self._latest(self._rows(spark), "batch_id", self.order).select(self.key, self.value)

    def get(self, spark: SparkSession, key) -> DataFrame:
        """(key, value) of one key; its bucket's files are the only ones opened."""
        number = spark.range(1).select(self.bucket(F.lit(key))).first()[0]
        rows = self._rows(spark).where((F.col("bucket") == number) & F.col(self.key).eqNullSafe(F.lit(key)))
        return self._latest(rows, "batch_id", self.order).select(self.key, self.value)

    def plan(self, spark: SparkSession) -> dict[int, list[int]]:
        """bucket -> batches whose levels the next compaction merges, the newest first. The newest batch of all stays
        as it is: a restart may still replay it."""
        levels = self.levels(spark)
        newest = max((own[0][0] for own in levels.values()), default=-1)
        out = {}
        for bucket, own in levels.items():
            own = [x for x in own if x[0] != newest]
            size, n = 0, 0
            while n < len(own) and (n == 0 or own[n][1] <= TIER * size):
                size, n = size + own[n][1], n + 1
            if n > 1:
                out[bucket] = [b for b, _ in own[:n]]
        return out

    def merge(self, spark: SparkSession, plan: dict[int, list[int]]) -> None:
        """Adds the merged rows to the newest level of each plan. They repeat what the older levels say, so the log
        reads the same whether or not these go afterwards. The rows are stored first: a level isn't read while it is
        written."""
        into = F.create_map(*[F.lit(x) for bucket, batches in plan.items() for x in (bucket, batches[0])])
        rows = spark.read.option("basePath", self.path).parquet(
            *[f"{self.path}/batch_id={b}/bucket={bucket}" for bucket, batches in plan.items() for b in batches])
        merged = stored(self._latest(rows, "batch_id", self.order), scratch(spark), "merged")
        merged = merged.withColumn("bucket", self.bucket(F.col(self.key))).withColumn("batch_id", into[F.col("bucket")])
        merged.repartition("bucket").write.mode("append").partitionBy("batch_id", "bucket").parquet(self.path)

    def compact(self, spark: SparkSession) -> dict[int, list[int]]:
        """Merges by ``plan`` and returns it. Run it between batches; a crash at any point changes no reading."""
        plan = self.plan(spark)
        if plan:
            self.merge(spark, plan)
            root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
            store = root.getFileSystem(spark._jsc.hadoopConfiguration())
            for bucket, batches in plan.items():
                for b in batches[1:]:
                    store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={b}/bucket={bucket}"), True)
        return plan
