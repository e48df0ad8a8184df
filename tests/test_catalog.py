"""Every registered query at the smallest scale, against its SQL."""

import pytest

from checks import catalog
from checks.run import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    verdict = compare(catalog.QUERIES[name](spark, SF), duck, catalog.SQL.get(name))
    assert verdict.startswith("ok"), verdict


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "flagship" in entry.queries()
