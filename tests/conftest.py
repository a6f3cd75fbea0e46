import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_session

    scratch = tempfile.mkdtemp(prefix="tidewater-test-")
    os.environ.setdefault("TIDEWATER_SCRATCH", os.path.join(scratch, "ckpt"))
    s = get_session(os.environ.get("TIDEWATER_TEST_MASTER", "local[4]"), app="tidewater-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
