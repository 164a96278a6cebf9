import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kelpie.session import build_session
    ck = tempfile.mkdtemp(prefix="kelpie-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=8, app="kelpie-tests",
                      extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL
