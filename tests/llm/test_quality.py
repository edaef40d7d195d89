import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from streamweave.llm.quality import features, ftrl, held_out, quality_model, quality_scores, tokens_of

GOOD = "the river runs past old stone houses and people walk there in evening light".split()


def corpus(seed, n=900):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        own = [rng.choice(GOOD) for _ in range(rng.randint(5, 60))]
        bad = i % 6 == 0
        if bad:
            own = [w.upper() + "!!" for w in own] if i % 12 else [own[0]] * len(own)
        docs.append((i, " ".join(own)))
        if i % 3 == 0:
            labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def tables(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(1)
    d, lab = tables(spark, docs, labels)
    scores = {r.doc_id: r.score for r in quality_scores(d, quality_model(d, lab)).collect()}
    out = [(scores[i] >= 0.3) == bool(y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) > 40 and np.mean(out) > 0.95


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(2, 300)
    d, lab = tables(spark, docs, labels)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    _, other = tables(spark, docs, turned)
    assert np.array_equal(quality_model(d, lab), quality_model(d, other))


def test_the_sample_of_labelled_rows_is_bounded(spark):
    docs, labels = corpus(3, 600)
    d, lab = tables(spark, docs, labels)
    assert np.count_nonzero(quality_model(d, lab, sample=20)) < np.count_nonzero(quality_model(d, lab))


def test_nulls_empty_texts_ties_and_empty_tables(spark):
    docs, labels = corpus(4, 300)
    docs += [(900, None), (901, ""), (902, " \n"), (903, docs[0][1]), (903, docs[0][1]), (None, docs[0][1]), (904, "word " * 40_000)]
    d, lab = tables(spark, docs, labels + [(905, None, 0), (None, 1, 0), (1, 7, 0), (906, 1, 1)])
    model = quality_model(d.withColumn("score", F.lit("clash")), lab)
    rows = quality_scores(d, model).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    bias = 1 / (1 + np.exp(-model[-1]))
    assert all(abs(r.score - bias) < 1e-12 for r in rows if r.doc_id in (900, 901, 902))
    assert len({r.score for r in rows if r.doc_id in (0, 903, None)}) == 1
    assert quality_scores(d.limit(0), model).count() == 0
    assert not quality_model(d, lab.limit(0)).any() and not quality_model(d.limit(0), lab).any()


def test_held_out_rule(spark):
    got = {r.doc_id: r.h for r in spark.createDataFrame([(i,) for i in (0, 1, 17, 10 ** 12, -7)] + [(None,)], "doc_id bigint")
           .select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in (0, 1, 17, 10 ** 12, -7)} | {None: True}


def test_ftrl_separates_and_features_have_length_one():
    of = lambda text: features(tokens_of(pa.array([text], pa.binary())).of(0))
    at, x = of(b"one two two three")
    assert abs((x * x).sum() - 1) < 1e-6 and len(at) == 6
    w = ftrl([(*of(b"good words here"), 1), (*of(b"bad junk there"), 0)] * 5)
    at, x = of(b"good words")
    assert w[at] @ x + w[-1] > 0
