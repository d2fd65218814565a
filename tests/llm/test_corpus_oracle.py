"""Corpus queries against their DuckDB SQL (the driver's check)."""

import pytest

from conftest import SF001, SF01
from cohortflow.llm.queries import ORACLE_SQL, QUERIES
from oracle_compare import compare, duck_connection


@pytest.mark.parametrize("sf", [SF001, SF01])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name, sf):
    res = compare(QUERIES[name](spark, sf), duck_connection(sf), ORACLE_SQL[name])
    assert res["ok"] and res["rows_spark"] > 0, res
