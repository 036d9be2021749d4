"""Every named query against its SQL equivalent on the smallest data."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from tests.conftest import FOLDER

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def database():
    return connect(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, database, name):
    left = QUERIES[name](spark, FOLDER).toPandas()
    assert differences(left, database.execute(ORACLE[name]).fetchdf()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 4
