"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import decimal
import math

import duckdb
import pytest

from parley import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if sql := registry.oracle_sql().get(name):
        result = duck.execute(sql)
        names = [x[0] for x in result.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    else:
        assert got


def test_entry_without_session():
    """The driver's module can be imported before there is a session, and knows the flagship."""
    import __spark_entry__

    assert registry.FLAGSHIP in __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
