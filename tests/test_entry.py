"""Driver contract: entry, queries, oracles; each oracle agrees at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from meterwise.plans import catalog
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Month", "Acorn_grouped", "avg"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 45


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", repr(v))
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return (type(v).__name__, v)


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    cur = duck.execute(E.oracle_sql()[name])
    o_names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_names)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(o_names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF001).count() > 0
