import pytest

from tests.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(4)
    yield session
    session.stop()
