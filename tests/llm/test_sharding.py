import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brute import crc
from streamweave.llm.sharding import MOST_SHARDS, sharded

SCHEMA = "doc_id bigint, text string"


def checked(df, rows, shards=8):
    out = df.collect()
    assert len(out) == len(rows)
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    slots, size, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in out:
        assert any(r["size"] == len((t or "").encode()) + 1 and r.text_crc32 == crc(t) for t in texts[r.doc_id])
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
        slots[r.shard].append(r.slot)
        size[r.shard] += r["size"]
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size, homes


def corpus(seed, n=1500):
    rng = random.Random(seed)
    return [(i, "\n".join("é" * rng.randrange(30) + "x" * int(rng.paretovariate(1.2)) for _ in range(rng.randrange(1, 6)))) for i in range(n)]


def test_equal_bytes(spark):
    rows = [(d, t[:2000]) for d, t in corpus(1)]
    size, homes = checked(sharded(spark.createDataFrame(rows, SCHEMA)), rows)
    assert len(size) == 8 and max(size.values()) < 1.06 * min(size.values())
    assert all(len(h) == 1 for h in homes.values())


def test_a_group_of_copies_stays_together(spark):
    rows = [(d, "copy " * 20 if d % 12 == 0 else t[:300]) for d, t in corpus(2)]
    size, homes = checked(sharded(spark.createDataFrame(rows, SCHEMA)), rows)
    assert all(len(h) == 1 for h in homes.values()) and max(size.values()) < 1.15 * min(size.values())


def test_a_text_that_outweighs_a_shard_is_parted(spark):
    rows = [(d, "copy " * 20 if d % 3 == 0 else t[:100]) for d, t in corpus(3)]
    size, homes = checked(sharded(spark.createDataFrame(rows, SCHEMA)), rows)
    assert max(size.values()) < 1.1 * min(size.values())
    assert sorted(len(h) for h in homes.values())[-2] == 1


def test_nulls_repeated_rows_few_rows_and_other_shard_counts(spark):
    rows = [(1, None), (2, ""), (3, "abc"), (3, "abc"), (None, "abc"), (4, "z" * 100_000)]
    checked(sharded(spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash"))), rows)
    rows = corpus(4, 600)
    size, _ = checked(sharded(spark.createDataFrame(rows, SCHEMA), shards=3), rows, 3)
    assert set(size) <= {0, 1, 2}
    empty = sharded(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_metadata_dimensions_of_ones_own(spark):
    rows = [(i, "t" * 50 + str(i)) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("when", F.col("doc_id") * 3.5)
    out = sharded(df, shards=4, dims={"when": F.col("when")}).groupBy("shard").agg(F.min("doc_id"), F.max("doc_id")).orderBy("shard").collect()
    assert [(r[1], r[2]) for r in out][0][0] == 0 and all(a[2] < b[1] for a, b in zip(out, out[1:]))


def test_many_shards_by_target_bytes(spark):
    rows = [(d, t[:120] + str(d)) for d, t in corpus(5, 6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    total = sum(len(t.encode()) + 1 for _, t in rows)
    size, homes = checked(sharded(df, target_bytes=total // 200 + 1), rows, 200)
    assert len(size) == 200 and all(len(h) == 1 for h in homes.values())
    assert max(size.values()) < 1.2 * total / 200 and min(size.values()) > 0.8 * total / 200
    with pytest.raises(ValueError):
        sharded(df, target_bytes=1, shards=1) if total > MOST_SHARDS else sharded(df, shards=MOST_SHARDS + 1)
    with pytest.raises(ValueError):
        sharded(df, shards=0)


def test_more_shards_than_rows_and_one_shard(spark):
    rows = [(d, "w" * d) for d in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    checked(sharded(df, shards=40), rows, 40)
    size, _ = checked(sharded(df, shards=1), rows, 1)
    assert set(size) == {0}


def test_the_cut_is_the_weighted_median_of_the_widest_dimension(spark):
    """Two shards of distinct places: the tree's cut against every possible cut of the sorted rows."""
    rng = random.Random(6)
    rows = [(i, "t" * rng.randrange(1, 60)) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("wide", F.col("doc_id") * 7 % 401).withColumn("narrow", F.lit(1))
    out = sharded(df, shards=2, dims={"narrow": F.col("narrow"), "wide": F.col("wide")})
    left = {r.doc_id for r in out.collect() if r.shard == 0}
    order = sorted(rows, key=lambda r: r[0] * 7 % 401)
    assert {d for d, _ in order[:len(left)]} == left
    goal = sum(len(t) + 1 for _, t in rows) / 2
    misses = [abs(sum(len(t) + 1 for _, t in order[:i]) - goal) for i in range(len(order))]
    assert misses[len(left)] == min(misses)
