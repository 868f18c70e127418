"""Every registered query against its SQL, on the smallest data set."""

import pytest
from compare import differences, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert differences(queries()[name](spark, SF_DIR), connection, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
