"""Every registered query against its SQL statement, on the whole test tables."""

import pytest

import __spark_entry__ as entry
from catalog.oracles import ORACLES
from catalog.queries import REGISTRY
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_statement():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == ""


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
