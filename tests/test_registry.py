"""Every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.plans.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "price_sk" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) > 0
        return
    odf = con.execute(sql).df()
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    assert sc == oc
    assert len(sr) == len(orr)
    assert sr == orr
