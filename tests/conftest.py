import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from streamweave.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.exists(SF001):
        pytest.skip("test data not present")
    return SF001
