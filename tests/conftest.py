import pytest

from millrace.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def table_path(tmp_path):
    return str(tmp_path / "table")
