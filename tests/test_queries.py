"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from newsloom.catalog.registry import ORACLES, QUERIES
from tests.compare import database, difference


@pytest.fixture(scope="module")
def con(small):
    return database(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, small, name):
    assert difference(spark, con, small, name) is None


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    rows = entry.entry(spark)
    assert rows.columns[:4] == ["doc_id", "titre", "contenu", "source"]
    assert rows.limit(1).count() == 1
