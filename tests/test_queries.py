"""Every registered query against its SQL on the smallest data folder."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries

from verification.compare import connect, difference, spark_rows, sql_rows
from verification.oracle import ORACLE
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, con, name):
    assert difference(spark_rows(spark, name, sf_dir), sql_rows(con, name)) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, sf_dir, name):
    assert spark_rows(spark, name, sf_dir)[1]
