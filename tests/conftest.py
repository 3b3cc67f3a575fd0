import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=8, app="clickweave-tests")
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickweave-test-")


@pytest.fixture()
def lines(spark):
    """Build a ``value`` DataFrame from python objects (dicts are JSON-encoded)."""

    def make(records):
        vals = [r if isinstance(r, str) else json.dumps(r) for r in records]
        return spark.createDataFrame([(v,) for v in vals], "value string")

    return make
