import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stopover.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def landing(tmp_path):
    """Three landed days: a failed search, and ten itineraries on each of two days."""
    from tests.landed import write_golden

    return write_golden(tmp_path / "landed")
