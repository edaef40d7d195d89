import random

import pytest

from brute import neighbours
from streamweave.llm.ann import nearest

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(seed, n, dim=24):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    return [(i, [round(rng.gauss(c, 0.7) * 64) / 64 for c in rng.choice(centres)], 0) for i in range(n)]


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_recall_order_and_scores(spark, parts):
    rows = vectors(parts, 3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = answers(nearest(df, df.where("vec_id % 100 = 0")))
    want = neighbours([r[:2] for r in rows], [q for q, _, _ in rows if q % 100 == 0])
    assert set(got) == set(want)
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {q: dict((v, d) for d, v in neighbours([r[:2] for r in rows], [q], len(rows))[q]) for q in list(want)[:3]}
    for q, known in exact.items():
        assert all(d == pytest.approx(known[v], rel=1e-12) for d, v in got[q])
    assert all(a == sorted(a) and len(a) == 10 for a in got.values())


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = vectors(9, 900)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, 0) for i, v, _ in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = answers(nearest(df, df.where("vec_id % 100 = 0")))
    assert [v for _, v in got[0]] == [3, 6, 9, 12, 15, 18, 21, 24, 27, 30]
    assert [v for _, v in got[300]] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]


def test_unusable_vectors_take_no_part(spark):
    bad = [(100, None, 0), (101, [0.0, 0.0], 0), (102, [1.0, None], 0), (103, [float("nan"), 1.0], 0), (104, [float("inf"), 1.0], 0),
           (105, [], 0), (106, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0)]
    good = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0)]
    df = spark.createDataFrame(good + bad, SCHEMA)
    got = answers(nearest(df, df))
    assert got == {0: [(1.0, 2), (2 ** 0.5, 1)], 1: [(1.0, 2), (2 ** 0.5, 0)], 2: [(1.0, 0), (1.0, 1)]}
    assert nearest(df.limit(0), df.limit(0)).count() == 0
    assert nearest(spark.createDataFrame(bad[:6], SCHEMA), df).count() == 0


def test_queries_in_blocks_and_one_lone_vector(spark, monkeypatch):
    from streamweave.llm import ann

    df = spark.createDataFrame(vectors(4, 120), SCHEMA)
    whole = answers(nearest(df, df))
    monkeypatch.setattr(ann, "QUERY_BLOCK", 25)
    assert answers(nearest(df, df)) == whole
    assert nearest(df.limit(1), df.limit(1)).count() == 0
