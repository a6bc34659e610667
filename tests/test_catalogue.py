"""Every screen query against its SQL on the small tables; those without SQL must run with a stable schema."""

import math

import duckdb
import pytest

from wellspring.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*sorted(df.columns)).collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert got or name in ("lof_filter",)
        return
    r = con.execute(sql)
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(c) for c in sorted(names)]
    assert got == sorted(repr(tuple(plain(row[i]) for i in at)) for row in r.fetchall())


def test_every_sql_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
