import base64
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from streamweave.llm import queries
from streamweave.llm.compression import BANDS, compressed, compression_verdicts, counted

SOME = ("The harbour lay quiet under a thin grey mist while two old fishermen mended nets beside the slipway and argued "
        "about weather. Behind them a cart loaded with empty barrels creaked uphill towards the brewery, its driver half "
        "asleep. Nobody noticed how the lighthouse keeper had climbed down early, carrying a lantern, three letters and "
        "an oilskin bag which he meant to post before noon. When church bells rang at last, gulls scattered over roofs, "
        "children ran between market stalls, and somebody shouted that fresh bread was ready near the fountain again.")


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def verdict(text):
    """(base_failed, kept) by the definition."""
    b, raw = base(text), (text or "").encode()
    failed = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]

    def ratio(part):
        r = len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))
        low, high = next((x, y) for n, x, y in reversed(BANDS) if n <= len(part))
        return low <= r <= high

    off = sum(len(raw[i:i + 4096]) for i in range(0, len(raw), 4096) if not ratio(raw[i:i + 4096]))
    return failed, not failed and ratio(raw) and off <= 0.25 * len(raw)


def test_base_counts_equal_brute_force():
    rng = random.Random(2)
    texts = [None, "", " ", "\n\n", "a", "one\ntwo\none\n \n \ntwo ", "é|ü é|ü é|ü <>#", "a b c a b c", "a a a", "a a", "x y z\x0bw\x1fq"]
    texts += ["".join(rng.choice(["a", "b", "ñ", " ", "\n", "|", "😀"]) for _ in range(rng.randint(0, 300))) for _ in range(200)]
    out = counted(pa.array([None if t is None else t.encode() for t in texts], pa.binary()))
    for i, t in enumerate(texts):
        assert {c: int(out[c][i]) for c in base(t)} == base(t), t
        assert out["n_bytes"][i] == len((t or "").encode())
    assert all(len(x) == 0 for x in counted(pa.array([], pa.binary())).values())


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    rng = random.Random(3)
    words = re.findall(r"\w+", SOME)
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n))
    noise = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    spaced = lambda n: " ".join(noise(6) for _ in range(n))
    rows = [(1, SOME), (2, prose(400)), (3, prose(20_000)), (4, SOME + "\n" + prose(3000)),
            (10, "buy now cheap " * 60), (11, spaced(3000)), (12, " ".join(f"line {i % 7} of the log says error code {i}" for i in range(4000))),
            (13, prose(4000) + " " + " ".join(f"row {i}" for i in range(9000))), (14, noise(60_000) + " " + prose(60)),
            (20, "too short"), (21, None), (22, "")]
    out = {r.doc_id: r for r in compression_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {d: (r.base_failed, r.kept) for d, r in out.items()} == {d: verdict(t) for d, t in rows}
    assert [d for d in sorted(out) if out[d].kept] == [1, 2, 3, 4]
    assert not out[11].base_failed and not out[13].base_failed and not out[14].base_failed
    assert out[21].ratio is None and out[13].greatest_chunk > 3.3 and out[13].off_share > 0.25


def test_chunks_are_fixed_pieces_of_bytes():
    press = zstandard.ZstdCompressor(level=3).compress
    text = ("ü" * 5000).encode()
    ratio, low, high, off, good = compressed(text, 4096, BANDS, press)
    assert ratio == len(text) / len(press(text)) and not good and off == 1
    assert (low, high) == tuple(f(len(p) / len(press(p)) for p in (text[:4096], text[4096:8192], text[8192:])) for f in (min, max))


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(7, SOME, 1), (7, SOME, 1), (None, SOME, 2)], "doc_id bigint, text string, kept int")
    rows = compression_verdicts(df).collect()
    assert [r.kept for r in rows] == [True] * 3 and len({r.ratio for r in rows}) == 1
    assert compression_verdicts(df.limit(0)).count() == 0
    renamed = df.select(F.col("doc_id").alias("ratio"), F.col("text").alias("n_words"))
    assert compression_verdicts(renamed, "ratio", "n_words").select("doc_id").where("doc_id is null").count() == 1


def test_query_equals_brute_force(spark, sf_dir):
    out = {r.doc_id: r for r in queries.op11_quality_rules(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(out) == len(docs)
    for d, t in docs:
        assert {c: out[d][c] for c in base(t)} == base(t)
        assert (out[d].base_failed, out[d].kept) == verdict(t)
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    assert all(r.kept or r.base_failed for d, r in out.items() if d in good)


@pytest.mark.parametrize("column,kind", [("n_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean"), ("n_repeat_words", "bigint")])
def test_types(spark, sf_dir, column, kind):
    assert dict(queries.op11_quality_rules(spark, sf_dir).dtypes)[column] == kind
