import pytest

from cuelake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
