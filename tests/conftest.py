import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contactforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
