"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    checked = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in checked.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows_of(result.columns, result.collect()) == rows_of(columns, checked.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_without_sql(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
