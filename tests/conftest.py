import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="tidemark-tests")
    # tests own the session: a private scratch root
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="tidemark-test-")
