import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from covlens.session import get_session
    s = get_session("local[4]", shuffle_partitions=4)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="covlens-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="covlens-test-")
