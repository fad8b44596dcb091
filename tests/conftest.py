import pytest

from obslake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
