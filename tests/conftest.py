import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session

    # tests own their checkpoint folder (the setting is only filled when unset)
    os.environ.setdefault("TIDEMARK_LOCAL_ROOT", tempfile.mkdtemp(prefix="tidemark-tests-"))
    s = get_session("local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_root(spark):
    from tidemark.session import scratch_dir

    return scratch_dir(spark, "test")
