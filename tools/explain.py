"""Print the formatted physical plan of registered queries.

    python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from streamweave import catalog  # noqa: E402
from streamweave.session import build_session  # noqa: E402


def main(argv):
    sf_dir, names = (argv[0], argv[1:]) if argv and argv[0].startswith("/") else ("/root/testdata/sf0.01", argv)
    spark = build_session()
    for n in names:
        print(f"===== {n}")
        catalog.QUERIES[n](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
