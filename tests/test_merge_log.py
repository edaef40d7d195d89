import random

from pyspark.sql import functions as F

from streamweave.sinks.merge_log import MergeLog

SCHEMA = "id string, temperature double, seq bigint"


def filled(spark, path, batches):
    log, want = MergeLog(str(path), "id", "temperature", buckets=4), {}
    for n, rows in enumerate(batches):
        log(spark.createDataFrame(rows, SCHEMA), n)
        for k, v, s in sorted(rows, key=lambda r: r[2]):
            want[k] = v
    return log, want


def held(log, spark):
    rows = log.read(spark).collect()
    assert len({r.id for r in rows}) == len(rows)
    return {r.id: r.temperature for r in rows}


def batches(n, seed=5):
    rng, seq = random.Random(seed), 0
    out = []
    for _ in range(n):
        rows = []
        for _ in range(60):
            seq += 1
            rows.append((rng.choice([None, "hot", "hot", *(f"k{i}" for i in range(30))]), float(seq), seq))
        out.append(rows)
    return out


def test_reads_points_and_compaction(spark, tmp_path):
    log, want = filled(spark, tmp_path / "log", batches(4))
    assert held(log, spark) == want
    assert [tuple(r) for r in log.get(spark, "hot").collect()] == [("hot", want["hot"])]
    assert log.get(spark, "absent").count() == 0 and log.get(spark, None).first().temperature == want[None]
    plan = log.get(spark, "hot")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket#" in plan.split("PartitionFilters")[1][:120]
    assert log.compact(spark) and held(log, spark) == want
    assert all(len(own) <= 2 for own in log.levels(spark).values())
    assert log.compact(spark) == {} and held(log, spark) == want


def test_a_crash_before_the_old_levels_go_and_a_replay(spark, tmp_path):
    rows = batches(4, 6)
    log, want = filled(spark, tmp_path / "log", rows)
    log.merge(spark, log.plan(spark))  # the crash: nothing deleted
    assert held(log, spark) == want
    log(spark.createDataFrame(rows[-1], SCHEMA), 3)  # the newest batch again
    log.compact(spark)
    assert held(log, spark) == want


def test_only_buckets_with_new_rows_are_merged(spark, tmp_path):
    log, want = filled(spark, tmp_path / "log", batches(3, 7))
    log.compact(spark)
    for n in (3, 4):
        log(spark.createDataFrame([("hot", 1000.0 + n, 1000 + n)], SCHEMA), n)
    log(spark.createDataFrame([("hot", 2000.0, 2000)], SCHEMA), 5)
    changed = log.compact(spark)
    own = spark.range(1).select(log.bucket(F.lit("hot"))).first()[0]
    assert own in changed and 4 in changed[own] and held(log, spark) == {**want, "hot": 2000.0}
    assert all(4 not in b for bucket, b in changed.items() if bucket != own)
