"""Every registered query against its SQL."""

import pytest
from compare import connect, difference

from grainmill.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_module():
    import __spark_entry__ as e

    assert e.queries().keys() >= CATALOG.keys() and e.oracle_sql().keys() >= CATALOG.keys()


@pytest.mark.parametrize("name", CATALOG)
def test_query(spark, con, name):
    query = CATALOG[name]
    assert difference(query.run(spark, SF), con, query.sql) is None
