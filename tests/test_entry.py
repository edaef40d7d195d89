"""The driver contract: entry() runs, every query has a stable schema, and
(on the small table set) matches its SQL oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, canon

from streamweave import catalog

ALL = sorted(catalog.ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["windowEnd", "rank", "itemId", "count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    q, o = catalog.QUERIES, catalog.ORACLES
    assert set(o) <= set(q)
    assert set(q) == set(o)


@pytest.mark.parametrize("name", ALL)
def test_oracle_matches_small(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = entry.queries()[name](spark, sf_dir)
    s = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    d = canon([c[0] for c in res.description], res.fetchall())
    assert s == d
