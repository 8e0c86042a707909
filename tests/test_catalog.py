"""Every query of the library's catalogue against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracles import digest
from tickerlens.plans.catalog import QUERIES
from tickerlens.sources.fixtures import TABLES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "day", "hour", "ticker", "frequency", "sentiment"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, con, name):
    sdf = QUERIES[name][0](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(QUERIES[name][1])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]
