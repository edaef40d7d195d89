import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from streamweave.llm import queries
from streamweave.llm.runs import Catchers, periodic_runs, runs_of


def brute(words, least=12):
    """[(start, length, period)]: stretches where words q apart match, of each the smallest q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i >= q and j - i + q >= least:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def kept(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def samples():
    rng = random.Random(4)
    yield []
    for n in (1, 11, 12, 13, 40, 257):
        yield ["x"] * n
    for letters in (1, 2, 3, 8):
        for _ in range(60):
            yield [rng.choice("abcdefgh"[:letters]) for _ in range(rng.randint(2, 90))]
    for _ in range(60):
        out = []
        while len(out) < 150:
            own = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))]
            out += (own * rng.randint(1, 5))[:rng.randint(1, 90)]
        yield out
    fib, thue = ["a", "ab"], "a"
    for _ in range(9):
        fib.append(fib[-1] + fib[-2])
        thue += thue.translate(str.maketrans("ab", "ba"))
    yield list(fib[-1])
    yield list(thue)


def test_equals_brute_force():
    texts = list(samples())
    n, runs, gone = runs_of(pa.array([" ".join(t).encode() for t in texts], pa.binary()), 12)
    at = 0
    for i, words in enumerate(texts):
        want = brute(words)
        assert [tuple(r[1:]) for r in runs.tolist() if r[0] == i] == want
        assert [w for w, g in zip(words, gone[at:at + len(words)]) if not g] == kept(words, want)
        at += len(words)


@pytest.mark.parametrize("step", [1, 2, 7, 64])
def test_the_result_does_not_depend_on_how_words_arrive(step):
    rng = random.Random(step)
    for words in list(samples())[5::9]:
        ids = np.array([hash(w) % 97 + 1 for w in words], np.uint64)
        online = Catchers(len(ids))
        at = 0
        while at < len(ids):
            more = rng.randint(0, step)
            online.append(ids[at:at + more])
            at += more
        assert [(a, b - a, q) for a, b, q in online.finish().tolist()] == brute(words)


def test_long_texts_take_linear_time():
    rng = random.Random(1)
    some = " ".join(str(rng.randint(0, 10 ** 6)) for _ in range(300_000))
    texts = [some, "one " * 300_000, ("one two " * 5000 + some[:50_000] + " ") * 5, "a b a " * 60_000]
    began = time.monotonic()
    n, runs, _ = runs_of(pa.array([t.encode() for t in texts], pa.binary()), 12)
    assert time.monotonic() - began < 30
    assert [1, 0, 300_000, 1] in runs.tolist() and [3, 0, 180_000, 3] in runs.tolist() and not (runs[:, 0] == 0).any()


def test_operator_on_nulls_empty_texts_repeats_and_clashing_columns(spark):
    rows = [(1, "go " * 12, "a"), (1, "go " * 12, "a"), (2, None, None), (3, "", "b"), (4, " \n\t", "b"),
            (None, "x y " * 6 + "z z", "c"), (5, "go " * 11, "c"), (6, "Go go " * 12, "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    out = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect())
    assert out == sorted([("1", 12, [(0, 12, 1)], "go")] * 2 + [
        ("2", 0, [], ""), ("3", 0, [], ""), ("4", 0, [], ""), ("None", 13, [(0, 12, 2)], "x y z z"),
        ("5", 11, [], " ".join(["go"] * 11)), ("6", 24, [(0, 24, 2)], "Go go")])
    assert periodic_runs(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    out = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(out)
    turned = 0
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            turned += 1
        if n > 3000:
            continue
        runs, r = brute(words), out[doc]
        assert r.n_runs == len(runs)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert r.collapsed_sha256 == sha(" ".join(kept(words, runs)))
    assert turned > 5
    kinds = dict(queries.op13_periodic_runs(spark, sf_dir).dtypes)
    assert {c: kinds[c] for c in ("n_runs", "start", "length", "period", "exponent_milli")} == dict.fromkeys(
        ("n_runs", "start", "length", "period", "exponent_milli"), "bigint")
