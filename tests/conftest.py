import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from featureflow.session import get_session
    s = get_session(app="featureflow-tests", master="local[4]", shuffle_partitions=4)
    # tests own their checkpoint folder only when the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ff-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf():
    return SMALL
