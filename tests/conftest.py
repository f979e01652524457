from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from seasonlab.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "seasonlab-tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A frame from tuples and a schema text."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
