"""Every registered query against its DuckDB oracle (the driver's check),
at sf0.001 so the suite stays quick; tools/oracle_check.py runs sf0.01."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)   # exact comparison
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return "NULL" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[name])
    want = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, got) == _rows(res.columns, want)


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "ts", "value", "event_id", "z", "abs_z"]
    assert df.count() > 0
