import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from retentio.session import local_session
    s = local_session(4, shuffle_partitions=4, app="retentio-tests")
    # tests set their own checkpoint folder only because none is configured
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retentio-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()
