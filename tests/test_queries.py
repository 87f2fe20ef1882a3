"""Every registered query against its SQL at the smallest scale."""

import pytest

from millrace import catalog
from tests.conftest import SMALL
from tests.oracle import compare, connect

NAMES = list(catalog.load())


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(spark, con, SMALL, name) == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).collect()) == 3
