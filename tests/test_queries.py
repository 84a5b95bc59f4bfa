"""Every query runs, and equals its SQL in another engine."""

import os

import duckdb
import pytest

from millrace import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if type(v).__name__ == "datetime" else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name in registry.ORACLES:
        cursor = duck.execute(registry.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        places = [names.index(c) for c in columns]
        assert got == sorted(repr(tuple(plain(r[i]) for i in places)) for r in cursor.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
