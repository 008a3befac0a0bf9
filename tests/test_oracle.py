"""Every registered query against DuckDB on the same files."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.helpers import as_multiset

#: Queries on telemetry; those of the optional part have tests of their own.
QUERIES, ORACLE = ({k: x for k, x in table.items() if not re.match(r"op\d+_|pipeline$", k)}
                   for table in (entry.queries(), entry.oracle_sql()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SMALL}/{file}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    expected = duck.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert as_multiset(result.columns, result.collect()) == as_multiset(columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 15
