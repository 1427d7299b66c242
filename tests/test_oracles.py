"""Every registered query against its DuckDB oracle: names, types, rows."""

import os

import pytest

import __spark_entry__ as entry_point
from workload import compare, oracles, registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry_point.oracle_sql()

TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "JSON": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
    "VARCHAR[]": "array<string>",
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_of_the_workload_has_an_oracle():
    assert set(oracles.oracles()) == set(registry.queries())
    assert set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert {c: TYPES[t] for c, t, *_ in described} == dict(df.dtypes)
    assert compare.spark_rows(df) == compare.duck_rows(duck, ORACLES[name])


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
