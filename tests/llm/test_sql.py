"""Corpus queries that have SQL give what DuckDB gives."""

import pytest

from rastra.llm import oracles, queries
from tests.conftest import SF
from tests.test_queries import rows


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_query(spark, duck, name):
    found, wanted = rows(queries.queries()[name](spark, SF).toPandas()), rows(duck.sql(oracles.oracle_sql()[name]).df())
    assert found == wanted
