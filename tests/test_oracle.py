"""Every registered query unit against its DuckDB oracle (the driver's check)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from cohortflow.queries import QUERIES
from conftest import SF001, SF01
from oracle_compare import compare, duck_connection

ORACLE = entry_module.oracle_sql()

# Units also checked at sf0.01 (the driver's scale); all run at sf0.001.
AT_SF01 = [
    "event_dataset", "pre_event_profile", "second_generation", "leaders_in_chain", "registration_summary",
    "attendance_before", "mentored_as_of", "stacked_batches",
]


@pytest.fixture(scope="module")
def duck001():
    return duck_connection(SF001)


@pytest.fixture(scope="module")
def duck01():
    return duck_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, duck001, name):
    res = compare(QUERIES[name](spark, SF001), duck001, ORACLE[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", AT_SF01)
def test_query_matches_oracle_sf001(spark, duck01, name):
    res = compare(QUERIES[name](spark, SF01), duck01, ORACLE[name])
    assert res["ok"], res
    assert res["rows_spark"] > 0


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert len(df.columns) == 39
    assert df.count() > 0


_DUCK_TYPES = {
    "LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR", "DateType": "DATE",
    "TimestampNTZType": "TIMESTAMP", "DoubleType": "DOUBLE", "BooleanType": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck001, name):
    df = QUERIES[name](spark, SF001)
    spark_types = {f.name: _DUCK_TYPES.get(type(f.dataType).__name__) for f in df.schema.fields}
    rel = duck001.sql(ORACLE[name])
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
