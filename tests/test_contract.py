"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as contract

SF_DIR = contract.SMOKE_DIR
# The corpus operators, where they are present, have tests of their own.
QUERIES = contract._own_queries()
ORACLE = contract._own_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    expected = duck.sql(ORACLE[name])
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in got.collect()) == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["outs_by_player_and_kind", "match_batsman_runs", "cogroup"])
def test_built_in_operators_stay_in_the_jvm(spark, name):
    assert "Python" not in plan(QUERIES[name](spark, SF_DIR))
