"""Every query of the catalogue gives the rows of its SQL on the smallest tables."""

import os

import duckdb
import pytest

from routelore.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = [t.removesuffix(".parquet") for t in sorted(os.listdir(SF))]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    return f"{float(v):.9g}" if isinstance(v, int) and abs(v) < 2**50 else str(v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    found = duck.sql(registry.SQL[name])
    assert sorted(df.columns) == sorted(found.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*found.columns).collect())
    assert got == sorted(tuple(map(plain, r)) for r in found.fetchall())
