import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridlens.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("gridlens-tests", "local[8]", spark__sql__shuffle__partitions="4",
                            spark__ui__showConsoleProgress="false", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def views(spark, sf_dir):
    from gridlens.plans.fixtures import Fixtures
    return Fixtures(spark, sf_dir)


@pytest.fixture
def rows(spark):
    """Small frames from SQL VALUES: ``rows("a int, b string", (1, 'x'), ...)``."""
    def make(schema, *values):
        return spark.createDataFrame(list(values), schema)
    return make
