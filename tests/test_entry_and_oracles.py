"""Driver contract: every registered query against its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.8g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "name", "nation"]
    assert df.count() == 160  # 150 customers + 10 suppliers at sf0.001


def test_every_query_has_a_callable():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        assert len(rows) >= 0
        return
    cur = duck.execute(oracle)
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_names)
    assert len(rows) == len(d_rows)
    assert _canon(df.columns, rows) == _canon(d_names, d_rows)
