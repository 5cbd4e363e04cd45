"""Every registered query against its SQL twin on the smallest test set."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from minekit.checks.oracle import ORACLES
from minekit.checks.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not present")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows(columns, table):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    picked = [tuple(plain(row[i]) for i in order) for row in table]
    return sorted(picked, key=lambda row: [(v is not None, v if v is not None else 0) for v in row])


# the queries of minekit.llm, which may be absent, are tested beside it
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sql, name):
    got = contract.queries()[name](spark, str(DATA))
    found = got.collect()
    text = contract.oracle_sql().get(name)
    if text is None:
        assert found
        return
    wanted = sql.sql(text)
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got.columns, found) == rows(wanted.columns, wanted.fetchall())


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["a", "b", "similarity"]


def test_only_the_library_tree_lacks_sql():
    assert set(QUERIES) - set(ORACLES) == {"mllib_tree_accuracy"}
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
