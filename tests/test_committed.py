"""Exactly-once delivery: failed, repeated and replayed batches leave each row once."""
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from streamweave.sinks.committed import CommittedFiles, Folder, read_committed

SCHEMA = StructType([StructField("seq", LongType()), StructField("value", StringType())])


@pytest.fixture
def source(spark, tmp_path):
    spark.dataSource.register(CommittedFiles)
    d = tmp_path / "in"
    d.mkdir()
    for i in range(3):
        pq.write_table(pa.table({"seq": pa.array(range(i * 40, i * 40 + 40), pa.int64()),
                                 "value": [f"v{j}" for j in range(40)]}), d / f"p{i}.parquet")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(d))


def deliver(rows, out, ckpt):
    q = (rows.writeStream.format("committed").option("path", str(out)).option("checkpointLocation", str(ckpt))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def seqs(spark, out):
    return sorted(r.seq for r in read_committed(spark, str(out), SCHEMA).collect())


def test_a_failed_batch_is_repeated_without_doubles(spark, source, tmp_path):
    out, flag = tmp_path / "out", str(tmp_path / "failed-once")

    @F.udf("bigint")
    def fails_once(seq):
        import os
        if seq == 75 and not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("lost")
        return seq

    rows = source.repartition(3).withColumn("seq", fails_once("seq"))
    with pytest.raises(Exception):
        deliver(rows, out, tmp_path / "ck")
    assert seqs(spark, out) == list(range(40))
    deliver(rows, out, tmp_path / "ck")
    assert seqs(spark, out) == list(range(120))


def test_a_replayed_batch_counts_once(spark, source, tmp_path):
    out, ckpt = tmp_path / "out", tmp_path / "ck"
    deliver(source, out, ckpt)
    # As after a crash between the sink's commit and the query's own.
    for f in (ckpt / "commits").iterdir():
        if f.name.strip(".").split(".")[0] == "2":
            f.unlink()
    deliver(source, out, ckpt)
    assert seqs(spark, out) == list(range(120))
    assert len(list((out / "data").iterdir())) == len(list((out / "commits").glob("*.json")))


def test_bounded_deliveries_by_name(spark, tmp_path):
    spark.dataSource.register(CommittedFiles)
    out = str(tmp_path / "out")
    rows = spark.range(100).select(F.col("id").alias("seq"), F.lit(None).cast("string").alias("value"))
    for batch in ("a", "a", "b"):
        rows.write.format("committed").option("path", out).option("batch", batch).mode("append").save()
    assert seqs(spark, out) == sorted([*range(100)] * 2)
    rows.limit(0).write.format("committed").option("path", out).option("batch", "c").mode("append").save()
    assert len(seqs(spark, out)) == 200
    with pytest.raises(Exception):
        rows.write.format("committed").option("path", out).option("batch", "../x").mode("append").save()
    assert read_committed(spark, str(tmp_path / "none"), SCHEMA).count() == 0


def test_files_of_lost_attempts_are_never_read(spark, tmp_path):
    folder = Folder(str(tmp_path / "out"), SCHEMA)
    batch = pa.record_batch({"seq": pa.array([1, 2], pa.int64()), "value": ["a", "b"]})
    lost, kept, other = (folder.write_file(iter([batch])) for _ in range(3))
    assert folder.commit_batch([kept, None], "0") and not folder.commit_batch([other], "0")
    assert seqs(spark, tmp_path / "out") == [1, 2]
    folder.drop([lost])
    assert [p.name for p in (tmp_path / "out" / "data").iterdir()] == [kept.name]
