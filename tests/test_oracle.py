"""Every registered query against its SQL, on the benchmark tables."""

import re

import pytest

import __spark_entry__ as spark_entry
from tests.compare import connect, duck_table, spark_table

SF_DIR = "/root/testdata/sf0.01"
QUERIES = spark_entry.queries()
ORACLE = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    """The text operators (opN_ and pipeline) have SQL where SQL can express them, and their own tests."""
    assert set(ORACLE) <= set(QUERIES)
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    columns, rows = spark_table(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_table(duck, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows, "an empty result checks nothing"


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
