import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.session import local_session  # noqa: E402

NOON = datetime(2025, 10, 17, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tidemark-tests")
    yield session
    session.stop()


@pytest.fixture
def at():
    """Zone-free time a number of seconds after the fixtures' noon."""
    return lambda seconds: NOON + timedelta(seconds=seconds)
