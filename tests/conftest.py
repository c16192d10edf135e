import pytest

from siftwell.session import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
