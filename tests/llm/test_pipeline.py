"""The pipeline against brute force, stage by stage, on rows with planted cases."""

import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import contamination, line_runs, near

WORDS = [a + b for a in ("ri", "sto", "hou", "li", "wal", "peo", "gar", "mo") for b in ("ver", "ne", "se", "ght", "king", "ple", "den", "on")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    passage = text(60)
    docs = [(i, "\n".join(text(rng.randint(8, 30)) for _ in range(rng.randint(1, 6)))) for i in range(240)]
    for i in range(0, 60, 3):
        docs[i] = (i, docs[i][1].upper().replace(" ", "!! "))  # junk
    docs += [(300 + i, docs[100][1]) for i in range(100)]  # a third of all rows are copies
    docs += [(500 + i, docs[120 + i][1].replace(WORDS[5], WORDS[6], 1)) for i in range(10)]
    docs += [(600 + i, text(12) + "\n" + passage + "\n" + text(9)) for i in range(6)]
    docs += [(700 + i, text(20) + " " + items[i][1] + " " + text(5)) for i in range(5)]
    docs += [(800, None), (801, ""), (802, docs[1][1]), (None, "without id"), (803, "long " * 9000), (1, docs[1][1])]
    # Two texts under one id, and rows without an id: each row stands for itself.
    junk, clean = [" ".join(f"{w.upper()}!!" for w in text(30).split()) for _ in range(2)], [text(30) for _ in range(4)]
    docs += [(900, clean[0]), (900, text(9) + " " + items[0][1]), (901, clean[1]), (901, junk[0]),
             (None, clean[2] + " " + items[1][1]), (None, junk[1]), (None, clean[3])]
    rows = [(d, t, "en", f"s{len(t or '') % 3}", len(t or "")) for d, t in docs]
    labels = [(i, 0 if i < 60 and i % 3 == 0 else 1, 0) for i in range(200) if i % 4]
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn(
        "score", F.lit("clash")).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name)) + "/t"
        f(spark, docs, folder).write.parquet(path)
        new = spark.read.parquet(path)
        if name != "packing":
            assert new.dtypes == docs.dtypes
        out.append((docs.collect(), new.collect()))
        docs = new
    return dict(zip([n for n, _ in corpus_pipeline.STAGES], out))


def pairs(rows):
    return sorted({(r.doc_id, r.text) for r in rows}, key=str)


def test_order_and_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_drops_junk_and_keeps_the_rest(stages):
    before, after = stages["quality"]
    gone = [r for r in before if r not in after]
    assert {r.doc_id for r in gone} == set(range(0, 60, 3)) | {901, None} and len(gone) == 22
    assert all("!!" in r.text for r in gone) and not any("!!" in (r.text or "") for r in after)


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    shared = {900, 901}
    assert sorted(r for r in before if r.doc_id in shared) == sorted(r for r in after if r.doc_id in shared)
    want = line_runs([(r.doc_id, r.text) for r in before if r.doc_id is not None and r.doc_id not in shared], 40)
    want = {d: "\n".join(lines) for d, lines in want.items() if lines}
    assert {r.doc_id: r.text for r in after if r.doc_id is not None and r.doc_id not in shared} == want | {800: None}
    assert sorted(r for r in after if r.doc_id is None) == sorted(r for r in before if r.doc_id is None)


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    kept = [r[0] for r in near(pairs([r for r in before if r.doc_id is not None]), 5, 80, 100) if r[3]]
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(kept)


def test_decontamination(spark, folder, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    verdicts = contamination([(r.doc_id, r.text) for r in before], items)
    assert sorted(map(str, after)) == sorted(str(r) for r, v in zip(before, verdicts) if not v[5])
    assert sum(v[5] for r, v in zip(before, verdicts) if r.doc_id in (900, None)) == 2
    assert not {700, 701, 702, 703, 704} & {r.doc_id for r in after}


def test_packing_holds_every_document(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}


def test_run_is_the_stages_in_turn(spark, folder, stages):
    key = lambda rows: sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows), key=str)
    total = lambda rows: {(r.doc_id, r.doc_tokens) for r in rows}
    assert total(corpus_pipeline.run(spark, folder).collect()) == total(stages["packing"][1])


def test_empty_tables(spark, folder, tmp_path):
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
