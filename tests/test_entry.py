"""Every registered query against its SQL on the same files."""

import os

import pytest

import __spark_entry__ as spark_entry
from tests.oracle import connect, spark_table, sql_table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    """Those for training data may lack it; their own tests compare them with brute force."""
    training, _ = spark_entry._training_data()
    assert spark_entry.oracle_sql().keys() <= spark_entry.queries().keys()
    assert spark_entry.queries().keys() - spark_entry.oracle_sql().keys() <= training.keys()


@pytest.mark.parametrize("name", spark_entry.oracle_sql())
def test_query_matches_sql(spark, connection, name):
    names, rows = spark_table(spark_entry.queries()[name](spark, SF_DIR))
    expected_names, expected = sql_table(connection, spark_entry.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 33
