"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entries
from dayfold import catalog
from compare import compare, connect


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_sql_has_a_query():
    assert set(entries.oracle_sql()) <= set(entries.queries())


def test_entry(spark):
    assert entries.entry(spark).columns == ["region", "dt", "net_sales", "lines"]


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, folder, name):
    assert compare(spark, duck, folder, name) == ""
