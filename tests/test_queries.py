"""Every named query against the SQL that states its result, on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entries
from tidefeed.plans.catalogue import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert oracle.compare(df, con, ORACLES[name]) > 0


def test_entry(spark):
    assert entries.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entries.queries())
