"""Every registered query against its SQL in DuckDB, values and types."""

import pytest

import __spark_entry__ as entry_points
from tests.conftest import TESTDATA

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()
SPARK_NAMES = {
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "INTEGER": "int",
    "TIMESTAMP": "timestamp_ntz",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def connection(duck):
    return duck("0.001")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 984


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, connection):
    result = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    rows = result.collect()
    if name not in ORACLES:
        assert rows
        return
    expected = connection.sql(ORACLES[name])
    assert dict(result.dtypes) == {c: SPARK_NAMES[str(t)] for c, t in zip(expected.columns, expected.types)}
    columns = sorted(result.columns)
    order = [expected.columns.index(c) for c in columns]

    def key(row):
        return [(value is None, str(value)) for value in row]

    got = sorted((tuple(row[c] for c in columns) for row in rows), key=key)
    wanted = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=key)
    assert got == wanted
