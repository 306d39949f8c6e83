"""Corpus queries against their SQL twins on the test tables."""

from __future__ import annotations

import duckdb
import pytest

from tripflow.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, small, name):
    result = queries()[name](spark, small)
    names = sorted(result.columns)
    got = sorted((tuple(r[c] for c in names) for r in result.collect()), key=repr)
    with duckdb.connect() as duck:
        for table in ("documents", "pages", "benchmark"):
            duck.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
        cursor = duck.execute(oracle_sql()[name])
        order = [d[0] for d in cursor.description]
        want = sorted((tuple(r[order.index(c)] for c in names) for r in cursor.fetchall()), key=repr)
    assert sorted(order) == names
    assert got == want
    assert got
