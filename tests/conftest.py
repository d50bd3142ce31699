import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardwatch.session import build_session

    s = build_session(
        "cardwatch-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cw-test-ckpt-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="cw-test-")
