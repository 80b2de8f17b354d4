"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import math

import pandas as pd
import pytest

from tidelog.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool | str | int):
        return v
    if isinstance(v, float):
        return round(v, 6)
    return str(pd.Timestamp(v))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    got = df.collect()
    result = duck.execute(catalog.SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(v) for v in r) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got), key=repr) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
