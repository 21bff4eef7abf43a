import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import build_session
    s = build_session("local[*]", app="ledgerloom-tests", shuffle_partitions=8)
    # tests own their shared folder only when the session has none
    if not s.sparkContext.getConf().get("spark.checkpoint.dir"):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-ck-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="ledgerloom-test-")
