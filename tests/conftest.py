import pytest

from logweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "4g")
    yield session
    session.stop()


@pytest.fixture
def log_of(spark):
    """Keyed log of (key, value, ord...) tuples."""
    from logweave.schema import LOG_SCHEMA

    def make(rows):
        return spark.createDataFrame(
            [(k, v, o if isinstance(o, list) else [o]) for k, v, o in rows],
            LOG_SCHEMA)
    return make
