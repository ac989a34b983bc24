import pytest

from itemsync.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "itemsync-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
