"""One local session for all tests."""

import pytest

from rillflow.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", cpus=4, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
