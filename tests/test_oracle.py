"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from perfkit.catalog import QUERIES
from tools.oracle_check import TABLES, canon, kind

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    return c


def test_every_query_has_an_entry():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(qs) and set(QUERIES) <= set(sqls)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    s_types = {f.name: kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {n: kind(str(t)) for n, t in zip(rel.columns, rel.types)}
    assert s_types == d_types
    assert canon(sdf.toPandas()) == canon(rel.df())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
