"""Order statistics by distributed selection against sorted lists."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamweave import catalog
from streamweave.operators import selection
from streamweave.operators.selection import order_statistics, window_median

FRACTIONS = [0.0, 0.25, 0.5, 0.9, 1.0]


def groups(seed=1):
    rng = random.Random(seed)
    yield "one", [3.5]
    yield "two", [1.0, 2.0]
    yield "ties", [7.0] * 50
    yield None, [rng.uniform(-5, 5) for _ in range(41)]
    yield "steep", [10.0 ** rng.randint(-300, 300) * rng.choice((-1, 1)) for _ in range(60)]
    yield "hot", [float(rng.randint(-1000, 1000)) for _ in range(3000)]
    yield "wide", [1.7e308, -1.7e308, 0.0, 5e-324, -5e-324, 1.0] * 4


@pytest.mark.parametrize("short,bins", [(1024, 1024), (8, 4), (0, 1024)])
def test_equals_sorted_lists(spark, monkeypatch, short, bins):
    monkeypatch.setattr(selection, "SHORT", short)
    monkeypatch.setattr(selection, "BINS", bins)
    own = dict(groups()) if bins > 4 else {k: v for k, v in groups() if k not in ("steep", "wide")}
    rows = [(k, x) for k, v in own.items() for x in v] + [("none", None), ("none", float("nan")), ("one", None)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    out = {r.g: r for r in order_statistics(df, ["g"], "v", FRACTIONS).collect()}
    assert set(out) == set(own)
    for g, values in own.items():
        values = sorted(values)
        assert out[g].n == len(values)
        for f, q in zip(FRACTIONS, out[g].q):
            at = f * (len(values) - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert q == low + (high - low) * (at - math.floor(at)), (g, f)
    assert order_statistics(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_infinite_values_end(spark, monkeypatch):
    monkeypatch.setattr(selection, "SHORT", 2)
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in (-inf, -inf, 1.0, 2.0, 3.0, inf, inf)], "v double").withColumn("g", F.lit(1))
    assert order_statistics(df, ["g"], "v", [0.5]).first().q == [2.0]


def test_a_window_with_a_third_of_all_rows(spark):
    n = 60_000
    df = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("id"),
        (F.col("id") % 3 * 1000).alias("timestamp"), F.pmod(F.col("id") * 7919, F.lit(10_007)).cast("double").alias("temperature"))
    out = {r.id: r for r in window_median(df, "10 seconds").collect()}
    v = [i * 7919 % 10_007 for i in range(0, n, 3)]
    assert out["hot"].n == n // 3 and out["hot"].median_temperature == float(np.median(v)) and out["hot"].window_end == 10_000
    plan = window_median(df, "10 seconds")._jdf.queryExecution().toString()
    assert "InPandas" not in plan and "ArrowEval" not in plan


def test_queries_have_no_python_node(spark, sf_dir):
    for name in ("window_median_1d", "temperature_quartiles"):
        assert "InPandas" not in catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
