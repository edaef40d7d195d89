"""Single-node yardstick: time the SQL oracles of the headline queries on
DuckDB over the same parquet files (best of N), one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from bench import HEADLINE  # noqa: E402
from streamweave.catalog import ORACLES  # noqa: E402
from tools.oracle_check import TABLES  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    threads = os.environ.get("BENCH_CPUS", "8")
    con = duckdb.connect()
    con.execute(f"SET threads = {int(threads)}")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    out = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()
            best = min(best, time.perf_counter() - t0)
        out[name] = round(best, 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf_dir, "threads": int(threads), "queries": out,
                      "total": round(sum(out.values()), 3)}))


if __name__ == "__main__":
    main()
