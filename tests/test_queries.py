"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver entry point."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["ID", "_action", "content_hash", "Source"]
    assert df.count() > 0


def test_every_query_has_a_unique_snake_name():
    names = list(E.queries())
    assert len(names) == len(set(names)) and all(n == n.lower() for n in names)
    assert set(E.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf.columns) > 0
        return
    ddf = duck.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert _rows(sdf) == _rows(ddf)
