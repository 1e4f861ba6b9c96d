"""Driver contract: entry runs, every registered query runs on the smallest
data set, and the SQL-checked ones agree with their DuckDB twins."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = ("o78", "o79", "o81", "o83", "o85", "o09")


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    return str(v) if hasattr(v, "isoformat") else v


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "status" in df.columns


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if not k.startswith(SLOW)))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    df = E.queries()[key](spark, sf_dir)
    r = duck.execute(E.oracle_sql()[key])
    oc = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(oc)
    order = sorted(range(len(oc)), key=lambda i: oc[i])
    sorder = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    a = sorted((tuple(_norm(x[i]) for i in sorder) for x in df.collect()), key=repr)
    b = sorted((tuple(_norm(x[i]) for i in order) for x in r.fetchall()), key=repr)
    assert a == b
