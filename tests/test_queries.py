"""Every registered query against its SQL counterpart; those without one must give rows."""

import pytest
from oracle import compare, connect

from lantern.plans.registry import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, db, name):
    query, sql = QUERIES[name]
    df = query(spark, sf_dir)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, sql, db) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())
