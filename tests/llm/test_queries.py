"""The registered queries over the small test tables: SQL where there is some, else the contract by brute force."""

import duckdb
import pytest

import __spark_entry__ as entry
from brute import crc, line_runs, neighbours
from streamweave.llm import queries
from test_packing import ids_of, share_of_padding
from tools.oracle_check import TABLES, canon, type_mismatches


def test_all_are_registered():
    names = list(entry.queries())
    assert [n for n in names if n.startswith("op") and n[2].isdigit()] == list(queries.QUERIES) and "pipeline" in names
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.ORACLES) < set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_dir)
    res = con.execute(queries.ORACLES[name])
    assert not type_mismatches(df, res)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([c[0] for c in res.description], res.fetchall())


def rows(spark, sf_dir, table, *cols):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols).collect()]


def test_packing(spark, sf_dir):
    docs = rows(spark, sf_dir, "documents", "doc_id", "text")
    out = queries.op4_packing(spark, sf_dir).collect()
    assert share_of_padding(out, dict(zip([d for d, _ in docs], ids_of([t for _, t in docs])))) < 0.03


def test_permutation_index(spark, sf_dir):
    vectors = rows(spark, sf_dir, "embeddings", "vec_id", "embedding")
    want = neighbours(vectors, [v for v, _ in vectors if v % 100 == 0])
    got = {}
    for r in queries.op5_permutation_index(spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want)
    assert sum(len(got[q] & {v for _, v in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_sharding(spark, sf_dir):
    docs = dict(rows(spark, sf_dir, "documents", "doc_id", "text"))
    out = queries.op6_kd_tree_sharding(spark, sf_dir).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in out} == {d: (len(t.encode()) + 1, crc(t)) for d, t in docs.items()}
    homes = {}
    for r in out:
        homes.setdefault(docs[r.doc_id], set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_line_dedup(spark, sf_dir):
    want = line_runs(rows(spark, sf_dir, "documents", "doc_id", "text"), 40)
    out = {r.doc_id: r for r in queries.op10_line_dedup(spark, sf_dir).collect()}
    assert all(out[d].n_lines - out[d].n_deleted == len(k) and (not k or out[d].text == "\n".join(k)) for d, k in want.items())


def test_quality_schema_and_secrets(spark, sf_dir):
    q = queries.op8_quality_classifier(spark, sf_dir)
    assert q.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    s = queries.op9_secret_scan(spark, sf_dir).collect()
    assert s and all(r.is_secret for r in s if r.finding.startswith("AKIA") and len(r.finding) == 20)
