"""Every registered query against its SQL twin on the test tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from helpers import cell
from tripflow.oracle import all_oracles
from tripflow.queries import all_queries

TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from '/root/testdata/sf0.001/{table}.parquet'"
        )
    return connection


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(queries()) and set(all_oracles()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, duck, small, name):
    result = all_queries()[name](spark, small)
    names = sorted(result.columns)
    got = sorted((tuple(cell(r[c]) for c in names) for r in result.collect()), key=repr)

    cursor = duck.execute(all_oracles()[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    order = list(described)
    want = sorted(
        (tuple(cell(r[order.index(c)]) for c in names) for r in cursor.fetchall()), key=repr
    )
    assert sorted(described) == names
    assert {c: TYPES[t] for c, t in result.dtypes} == described
    assert got == want
    assert got


def test_entry_has_all_hours(spark):
    result = entry(spark)
    assert [r["hour_of_day"] for r in result.collect()] == list(range(24))
