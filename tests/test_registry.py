"""Every registered query runs at sf0.001 and agrees with its SQL twin."""

import hashlib
import os

import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    import datetime
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5(repr([_norm(r[i]) for i in order]).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["video_id", "video_title", "channel_title", "collected_date", "view_count",
                          "like_count", "comment_count"]


def test_every_query_has_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 70


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, sf, duck, name):
    df = E.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)
