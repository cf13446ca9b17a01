"""Every registered query against its DuckDB oracle at sf0.001 (the driver
does the same at sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import ORACLE_SQL, QUERIES, entry, oracle_sql, queries
from lakezones.queries import TABLES



def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    got = sorted((tuple(_norm(v) for v in r) for r in df.collect()), key=_key)
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    perm = [rel.columns.index(c) for c in df.columns]
    exp = sorted((tuple(_norm(r[i]) for i in perm) for r in rel.fetchall()), key=_key)
    assert got == exp
