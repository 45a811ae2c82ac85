import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tenurekit.session import build_session
    ck = tempfile.mkdtemp(prefix="tk-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ck})
    yield s
    s.stop()
