import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallywright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def strings(spark):
    """A one-column table of the given strings."""

    def build(*values, name="value"):
        return spark.createDataFrame([(value,) for value in values], f"{name} string")

    return build
