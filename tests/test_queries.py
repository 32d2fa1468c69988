"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def text(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = sorted(tuple(text(v) for v in r) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    assert got == sorted(tuple(text(r[i]) for i in order) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
