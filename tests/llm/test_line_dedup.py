import random

import pytest

from brute import line_runs
from streamweave.llm.line_dedup import drop_repeated_runs


def kept(spark, rows, min_words):
    out = drop_repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string"), min_words=min_words)
    return {r.doc_id: (r.text, r.n_lines, r.n_deleted) for r in out.collect()}


def corpus(seed, n=40):
    rng = random.Random(seed)
    lines = [" ".join("w%d" % rng.randrange(30) for _ in range(rng.choice((0, 1, 1, 2, 3, 6)))) for _ in range(25)]
    rows = []
    for d in range(n):
        own = [rng.choice(lines) if rng.random() < 0.7 else f"only {d} {i}" for i in range(rng.randrange(1, 14))]
        if rows and rng.random() < 0.5:
            other = rng.choice(rows)[1].split("\n")
            a = rng.randrange(len(other))
            own[1:1] = other[a:a + rng.randrange(1, 9)]
        rows.append((d * 7 % 1009, "\n".join(own)))
    return rows


@pytest.mark.parametrize("seed,min_words", [(1, 1), (2, 4), (3, 7), (4, 15), (5, 15)])
def test_equals_every_run_of_every_length(spark, seed, min_words):
    rows = corpus(seed)
    want = line_runs(rows, min_words)
    for d, (text, n, gone) in kept(spark, rows, min_words).items():
        assert n - gone == len(want[d])
        if want[d]:
            assert text == "\n".join(want[d])


def test_a_group_with_a_third_of_all_rows_and_long_runs(spark):
    passage = "\n".join(f"line {i} of the passage" for i in range(70))
    rows = [(d, (f"own {d}\n" if d % 2 else "") + passage) for d in range(30)] + [(100 + d, f"text {d} alone") for d in range(60)]
    out = kept(spark, rows, 40)
    assert out[0] == (passage, 70, 0)
    assert all(out[d] == (f"own {d}" if d % 2 else "", 70 + d % 2, 70) for d in range(1, 30))
    assert all(out[100 + d] == (f"text {d} alone", 1, 0) for d in range(60))


def test_nulls_empty_texts_and_repeated_rows(spark):
    text = "a b c d e\nf g h"
    rows = [(1, text), (1, text), (2, "x\n" + text), (3, None), (4, ""), (5, ""), (None, text), (6, "y" * 30_000), (7, "y" * 30_000 + "\n")]
    out = drop_repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string"), min_words=5)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_deleted) for r in out.collect()), key=str)
    want = [(1, text, 2, 0), (1, text, 2, 0), (2, "x", 3, 2), (3, None, 0, 0), (4, "", 1, 0), (5, "", 1, 0), (None, text, 2, 0),
            (6, "y" * 30_000, 1, 0), (7, "y" * 30_000 + "\n", 2, 0)]
    assert got == sorted(want, key=str)


def test_empty_table_and_clashing_columns(spark):
    assert kept(spark, [], 3) == {}
    df = spark.createDataFrame([(1, "a b c", 1, "s"), (2, "a b c", 2, "t")], "doc_id bigint, text string, raw int, gone string")
    assert {r.doc_id: r.text for r in drop_repeated_runs(df, min_words=3).collect()} == {1: "a b c", 2: ""}
