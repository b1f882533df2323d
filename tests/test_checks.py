"""Every registered query against the same result in SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as checks
from queries import CHECKS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    with duckdb.connect() as connection:
        for name in TABLES:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
        yield connection


def test_every_query_has_its_sql():
    assert all(sql for _, sql in CHECKS.values())
    assert CHECKS.keys() <= checks.queries().keys()


@pytest.mark.parametrize("name", CHECKS)
def test_query_equals_sql(spark, sql, name):
    got = checks.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    expected = sql.execute(checks.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    picked = [names.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in picked)) for row in expected.fetchall())
    have = sorted(repr(tuple(row)) for row in got.select(*[f"`{c}`" for c in columns]).collect())
    assert have == want


def test_entry_has_rows(spark):
    assert not checks.entry(spark).isEmpty()
