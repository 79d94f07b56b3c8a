"""Every query that SQL can express, beside that SQL, on the smallest tables."""

import pytest

from panelwise.plans.catalog import ORACLES, QUERIES
from tools.check_oracles import connect, difference


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf, db):
    got = QUERIES[name](spark, sf).toPandas()
    assert difference(got, db.execute(ORACLES[name]).df()) is None
    assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
