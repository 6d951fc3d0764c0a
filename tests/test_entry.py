"""Driver contract: entry runs, every query has a callable, oracle keys are a subset,
and every query agrees with its DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["rowkey", "family", "qualifier", "value"]
    assert df.count() > 0


def test_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def _norm(v):
    return "\0" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    si = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    di = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    a = sorted(tuple(_norm(r[i]) for i in si) for r in sdf.collect())
    b = sorted(tuple(_norm(r[i]) for i in di) for r in rel.fetchall())
    assert len(a) == len(b)
    assert a == b
