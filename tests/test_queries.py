"""Every registered query against its SQL, over whole tables."""

import importlib

import pytest
from compare import duck_rows, spark_rows

from txnguard.plans.catalog import QUERIES
from txnguard.plans.oracle import ORACLE_SQL as SQL

entry_points = importlib.import_module("__spark_entry__")
FOLDER = "/root/testdata/sf0.01"


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_points.queries().items()
    assert SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, key):
    names, rows = spark_rows(QUERIES[key](spark, FOLDER))
    expected_names, expected = duck_rows(SQL[key], FOLDER)
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows, "nothing found: the check is empty"


def test_entry_gives_alerts(spark):
    assert entry_points.entry(spark).count() > 0
