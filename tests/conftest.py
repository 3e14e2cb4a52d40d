import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import small_session  # noqa: E402
from tradeweir.session import scratch_database  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = small_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    return scratch_database(spark, "test")
