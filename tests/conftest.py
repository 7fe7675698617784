import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidefeed.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("tidefeed-tests", cores=8, spark__checkpoint__dir=str(shared))
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a table from a DDL schema and tuples."""

    def make(ddl, *values):
        return spark.createDataFrame(list(values), ddl)

    return make


def values(df):
    """Rows as a sorted list of tuples."""
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan_of(df):
    """The physical plan, after the query has run where it is adaptive."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
