import pytest

from panelwise.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows(spark):
    """Build a frame from tuples."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build
