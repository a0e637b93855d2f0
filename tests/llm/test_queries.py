"""Every registered query of the subpackage that SQL can express, on the whole test tables."""

import pytest

from queixa.llm.registry import QUERIES, SQL
from tests.compare import connect, difference


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) == ""
