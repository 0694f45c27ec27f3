import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bidtrail.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, memory="4g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Collect a frame as a list of tuples, in text order."""
    return lambda df: sorted(map(tuple, df.collect()), key=str)
