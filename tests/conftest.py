import pytest

from sarweave.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
