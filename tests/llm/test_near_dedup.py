import random

import numpy as np
import pytest

from brute import near
from streamweave.llm import near_dedup
from streamweave.llm.common import components
from streamweave.llm.near_dedup import near_duplicates, sketches


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def copies(seed, n=60, vocabulary=400):
    """Texts, exact copies and copies with some words changed; a third of all rows in one group."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 90))] for _ in range(n // 3)]
    rows = []
    for i in range(n):
        own = list(base[0] if i % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 5))):
            own[rng.randrange(len(own))] = rng.choice(words)
        sep = rng.choice((" ", "  ", "\n", "\t"))
        rows.append((1000 - i, sep.join(w.upper() if rng.random() < 0.1 else w for w in own)))
    return rows


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.mark.parametrize("seed,k,over", [(1, 3, 85), (2, 5, 80)])
def test_equals_all_pairs(spark, seed, k, over):
    rows = copies(seed) + [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "a b"), (7, "x" * 50_000)]
    assert got(near_duplicates(docs_of(spark, rows), k=k, over=over)) == sorted(near(rows, k, over, 100))


def test_blocks_of_a_large_cluster_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rows = copies(3, 75, 5000)
    assert got(near_duplicates(docs_of(spark, rows), k=3, over=85)) == sorted(near(rows, 3, 85, 100))


def test_repeated_rows_null_ids_and_other_columns(spark):
    text = "the same words stand here again and again and again"
    df = spark.createDataFrame([(5, text, "a", 1), (5, text, "a", 1), (9, text, "b", 2), (None, text, "c", 3), (None, "else", "d", 4)],
                               "doc_id bigint, text string, node string, bucket int")
    out = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert out == {(5, 5, True), (9, 5, False), (None, 5, False), (None, None, False)}
    assert near_duplicates(df).count() == 5


def test_empty_table(spark):
    out = near_duplicates(docs_of(spark, []))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept", "text_hash"] and out.count() == 0


def test_sketches_fill_and_agree_as_often_as_sets_meet():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    t = 1024
    for n, meet in ((1, 1), (40, 30), (2000, 1000)):
        a, b = pool[:n], np.concatenate((pool[:meet], pool[n:2 * n - meet]))
        s = sketches([a, b], t)
        assert (s != near_dedup.EMPTY).all()
        j = meet / (2 * n - meet)
        assert abs((s[0] == s[1]).mean() - j) < 5 * (j * (1 - j) / t) ** 0.5 + 1e-9


def test_components_of_a_chain_and_a_hub(spark, tmp_path):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201)]
    out = components(spark.createDataFrame(edges, "a bigint, b bigint"), str(tmp_path), "c")
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)} | {201: 200}
    assert {r.node: r.root for r in out.collect()} == want


def test_pairs_at_each_use_s_threshold_share_a_bucket():
    import numpy as np

    from streamweave.llm.near_dedup import band_hashes, banding

    assert banding(85, 100) == (32, 7) and banding(80, 100) == (41, 6)
    for over in (50, 80, 85, 90, 95):
        bands, rows = banding(over, 100)
        assert (1 - (over / 100) ** rows) ** bands <= 4.3e-6
    assert banding(100, 100)[0] == 1
    # 32 bands of 7 lose 1 in 1,860 pairs at 0.8.
    rng, (bands, rows) = np.random.default_rng(5), banding(80, 100)
    for _ in range(6):
        items = rng.integers(0, 2 ** 64, (2000, 100), np.uint64)
        a, b = (band_hashes(sketches(list(items[:, own]), bands * rows), bands, rows) for own in (slice(0, 90), slice(10, 100)))
        assert (a == b).any(axis=1).all()
