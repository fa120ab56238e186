import pytest

from annalith.session import build_session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session
