import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(app="tidemark-tests", cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmpdir_spark(spark):
    from tidemark.session import scratch_path

    return scratch_path(spark, "test")
