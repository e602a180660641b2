import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g", "tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def failing(spark):
    """Run a DataFrame that must fail and return the message."""

    def run(df):
        with pytest.raises(Exception) as caught:
            df.collect()
        return str(caught.value)

    return run


def rows(df):
    """Rows as plain tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
