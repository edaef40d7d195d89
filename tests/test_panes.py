"""Panes, mergeable distinct sets and user aggregates against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from streamweave import catalog
from streamweave.functions.udf import aggregate, partial_states
from streamweave.operators.distinct import DistinctLog, merged_sets, pane_sets, set_sizes, window_set_sizes, word_sets
from streamweave.operators.panes import sliding_aggregate, sliding_distinct
from tests.test_plans_shape import exchanges, plan, static_plans  # noqa: F401


def events(n=600, seed=1):
    rng = random.Random(seed)
    return [(rng.choice((None, "a", "b", "hot", "hot")), rng.randint(-50_000, 90_000), rng.randint(-5, 300)) for _ in range(n)]


def windows_of(t, size, slide):
    s = t - t % slide
    while s > t - size:
        yield s
        s -= slide


@pytest.mark.parametrize("size,slide", [(5000, 2000), (6000, 3000), (4000, 4000), (3000, 7000), (7000, 1000), (5000, None)])
def test_windows_equal_brute_force(spark, size, slide):
    rows = events()
    df = spark.createDataFrame([*rows, ("a", None, 1)], "k string, t bigint, v bigint")
    step = slide or size
    count, best, seen = Counter(), {}, defaultdict(set)
    for k, t, v in rows:
        for s in windows_of(t, size, step):
            count[s, k] += 1
            best[s, k] = max(best.get((s, k), v), v)
            seen[s, k].add(v % 7)
    own = f"{size} ms", f"{slide} ms" if slide else None
    out = sliding_aggregate(df, "k", *own, "t", {"n": (F.count(F.lit(1)), F.sum), "top": (F.max("v"), F.max)}).collect()
    assert {(r.window_start, r.k): (r.n, r.top) for r in out} == {w: (count[w], best[w]) for w in count}
    assert len(out) == len(count) and all(r.window_end - r.window_start == size for r in out)
    out = sliding_distinct(df, "k", *own, "t", F.pmod("v", F.lit(7))).collect()
    assert {(r.window_start, r.k): r["count"] for r in out} == {w: len(m) for w, m in seen.items()}


def test_seconds_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4)], "k string, t bigint")
    out = sliding_aggregate(df, "k", "4 seconds", "2 seconds", "t", {"n": (F.count(F.lit(1)), F.sum)}, unit="s").collect()
    assert sorted((r.window_start, r.n) for r in out) == [(0, 1), (2000, 2), (4000, 1)]
    assert sliding_aggregate(df.limit(0), "k", "4 seconds", "2 seconds", "t", {"n": (F.count(F.lit(1)), F.sum)}).count() == 0


@pytest.mark.parametrize("name", ["hot_items_top5", "dedup_hot_items", "item_view_counts", "hot_items_distinct_seconds"])
def test_raw_rows_are_not_copied(spark, sf_dir, static_plans, name):  # noqa: F811
    """Copies to windows come after the panes' aggregate, and no exchange follows them but the top-n's."""
    p = plan(spark, catalog.QUERIES[name](spark, sf_dir))
    assert "Expand" not in p and p.count("Generate explode") == 1
    above, below = p.split("Generate explode")
    assert "HashAggregate" in below and exchanges(above) == (0 if name == "item_view_counts" else 1)


def shuffled_rows(df) -> int:
    """Rows written to all exchanges of a plan without adaptive changes."""
    root = df._jdf.queryExecution().executedPlan()
    root.execute().count()
    total, todo = 0, [root]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_shuffled_rows_do_not_grow_with_size_over_slide(spark, static_plans):  # noqa: F811
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") % 3).alias("k"), (F.col("id") % 4000 * 1000).alias("t"))
    rows = [shuffled_rows(sliding_aggregate(df, "k", size, "10 s", "t", {"n": (F.count(F.lit(1)), F.sum)}))
            for size in ("20 s", "400 s")]
    assert rows[0] == rows[1] and 0 < rows[0] < 20_000


def test_sets_equal_python_sets(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice((rng.randint(-200, 200), rng.randint(-2 ** 63, 2 ** 63 - 1), 0, -1, 2 ** 63 - 1, -2 ** 63)))
            for _ in range(2000)] + [("a", None), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    want = {g: len({v for h, v in rows if h == g and v is not None}) for g in "ab"}
    sets = word_sets(df, ["g"], "v")
    assert {r.g: r.users for r in set_sizes(sets, ["g"]).collect()} == want
    # Both halves merged are the whole, also if a part is merged twice.
    halves = word_sets(df.where("v % 2 = 0"), ["g"], "v").union(word_sets(df.where("v % 2 <> 0"), ["g"], "v")).union(sets)
    assert {r.g: r.users for r in set_sizes(merged_sets(halves, ["g"]), ["g"]).collect()} == want


def test_sliding_sets_from_stored_hours(spark):
    rows = [(random.Random(i).randint(0, 40), i * 137) for i in range(500)]
    df = spark.createDataFrame(rows, "userId bigint, timestamp bigint")
    hours = pane_sets(df, "userId", "1 hour")
    h = 3_600_000
    seen = defaultdict(set)
    for u, t in rows:
        for s in windows_of(t * 1000, 5 * h, 2 * h):
            seen[s].add(u)
    out = window_set_sizes(hours, "1 hour", "5 hours", "2 hours").collect()
    assert {r.window_start: r.users for r in out} == {s: len(m) for s, m in seen.items()}
    with pytest.raises(ValueError):
        window_set_sizes(hours, "1 hour", "90 minutes")


def test_log_of_sets_survives_replays_and_compaction(spark, tmp_path):
    rows = [(i % 50, i * 900) for i in range(400)]
    frame = lambda part: spark.createDataFrame(part, "userId bigint, timestamp bigint")
    want = {r.pane: r.users for r in set_sizes(pane_sets(frame(rows), "userId", "1 hour"), ["pane"]).collect()}
    log = DistinctLog(f"{tmp_path}/log", "userId")
    sizes = lambda: {r.pane: r.users for r in set_sizes(log.read(spark), ["pane"]).collect()}
    assert sizes() == {}
    log.compact(spark)
    log.append(frame(rows[:100]), 0)
    log.append(frame(rows[100:300]), 1)
    log.append(frame(rows[100:300]), 1)  # replayed
    log.compact(spark)
    log.append(frame(rows[300:]), 2)
    assert sizes() == want
    # A crash while the next compacted table is written leaves a folder without its mark: nobody reads it.
    log.read(spark).limit(3).write.parquet(f"{tmp_path}/log/upto-2")
    (tmp_path / "log" / "upto-2" / "_SUCCESS").unlink()
    assert sizes() == want
    log.compact(spark)
    assert sizes() == want


def test_queries_read_rows_once_for_all_days(spark, sf_dir):
    p = plan(spark, catalog.QUERIES["daily_users_from_hours"](spark, sf_dir))
    assert "events.parquet" not in p and "SortAggregate" not in p


def test_states_are_combined_before_the_shuffle(spark):
    top = lambda v: float(v.max())
    df = spark.range(0, 300_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"), F.lit(1.0).alias("v"))
    states = partial_states(df, "k", "v", top, top, "double")
    assert states.count() <= 6 * 21
    few = partial_states(df, "k", "v", top, top, "double", most_keys=5)
    assert few.count() > 6 * 21  # a full table is sent and filled anew
    total = lambda v: float(v.sum())
    want = {r.k: r.n for r in df.groupBy("k").agg(F.sum("v").alias("n")).collect()}
    for most in (5, 1000):
        assert {r.k: r.s for r in aggregate(df, "k", "v", total, total, "double", name="s", most_keys=most).collect()} == want


def test_aggregate_of_null_keys_nan_keys_struct_states_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1), (2.5, 2), (None, 3), (float("nan"), 4), (float("nan"), 5), (2.5, None)], "k double, v bigint")
    mean = dict(partial=lambda v: {"s": float(v.sum()), "n": int(v.count())},
                merge=lambda x: {"s": sum(y["s"] for y in x), "n": sum(y["n"] for y in x)},
                return_type="double", state_type="struct<s: double, n: bigint>", result=lambda s: s["s"] / s["n"])
    for parts in (1, 6):
        out = aggregate(df.repartition(parts), "k", "v", **mean).collect()
        assert sorted((str(r.k), r.value) for r in out) == [("2.5", 2.0), ("None", 2.0), ("nan", 4.5)]
    assert aggregate(df.limit(0), "k", "v", **mean).count() == 0
    clash = df.withColumnRenamed("v", "state").withColumnRenamed("k", "value")
    assert aggregate(clash, "value", "state", **mean, name="key").columns == ["value", "key"]
