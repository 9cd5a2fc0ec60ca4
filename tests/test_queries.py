"""Every registered query against its SQL, on the smallest tables."""

import pytest

from oracle import difference, duck, entry

SF_DIR = entry.SMALLEST


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    assert difference(spark, con, SF_DIR, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
