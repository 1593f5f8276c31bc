"""Every registered query with a SQL twin gives the twin's whole result at the smallest scale."""
import compare
import pytest

import __spark_entry__ as entry
from contactforge import catalog

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_registry_is_consistent():
    own, twins = set(catalog.queries()), set(catalog.oracle_sql())
    assert set(SQL) <= set(entry.queries()) and own <= set(entry.queries()) and twins <= set(SQL)
    assert own - twins == {"train_models", "class_scoring"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert compare.compare(spark, duck, FOLDER, name, entry.queries()[name], SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
