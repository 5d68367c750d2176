import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from parcelkit.session import checkpoint_dir, get_session
    s = get_session("local[4]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(s, tempfile.mkdtemp(prefix="parcelkit-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="parcelkit-test-")
