"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import catalog
from compare import compare, connect


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, connection, folder, name):
    count, problem = compare(spark, connection, folder, name)
    assert not problem
    assert count


def test_every_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_is_the_cube(spark):
    df = entry.entry(spark)
    assert df.columns == ["scope", "form_id", "payment_method", "revenue", "transactions"]
    assert df.count() > 0
