import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from agora.session import local_session  # noqa: E402
from agora.sources.staging import scratch_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def fresh_path(spark):
    """A new folder name for every use."""
    return lambda: f"{scratch_root(spark)}/agora-test-{uuid.uuid4().hex}"


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
