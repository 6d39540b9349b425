"""Every query with SQL gives what DuckDB gives on the same tables."""

import os

import duckdb
import pytest

from gleanery.plans import catalog
from tests.conftest import SF, normal

QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert normal([tuple(r) for r in got.select(*(f"`{c}`" for c in cols)).collect()]) == normal(want[cols].itertuples(index=False, name=None))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
