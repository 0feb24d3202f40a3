import pytest

from rostrum.session import session

#: Made when tests are collected, since Column expressions in modules need a session.
_SPARK = session("local[4]", partitions=4, memory="4g")


@pytest.fixture(scope="session")
def spark():
    return _SPARK
