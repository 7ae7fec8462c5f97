"""Every catalogue query against its SQL on the same tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(name, spark, sf_dir, tables):
    assert difference(queries()[name](spark, sf_dir), tables, oracle_sql()[name]) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_gives_rows(spark, sf_dir):
    assert entry(spark).count() > 0
