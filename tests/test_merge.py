"""Merge family: semantics, both physical plans, and properties."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronoledger.operators import merge as M

SCHEMA = "k string, v bigint, note string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_all_branches(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 9, "nullkey")], SCHEMA)
    s = spark.createDataFrame([("b", 20, None), ("c", 30, "new"), (None, 99, "src-null")], SCHEMA)
    want = {("a", 1, "x"), ("b", 20, None), ("c", 30, "new"), (None, 9, "nullkey"), (None, 99, "src-null")}
    for strategy in ("broadcast", "shuffle"):
        # NULL keys never match: both null-key rows survive
        assert {tuple(r) for r in M.upsert(t, s, "k", strategy=strategy).collect()} == want


def test_insert_only_first_write_wins(spark):
    t = spark.createDataFrame([("a", 1, "old")], SCHEMA)
    s = spark.createDataFrame([("a", 2, "new"), ("b", 3, "b")], SCHEMA)
    for strategy in ("broadcast", "shuffle"):
        assert rows(M.insert_only(t, s, "k", strategy=strategy)) == [("a", 1, "old"), ("b", 3, "b")]


def test_update_only_ignores_unmatched(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], SCHEMA)
    s = spark.createDataFrame([("a", 5, None), ("z", 7, "z")], SCHEMA)
    for strategy in ("broadcast", "shuffle"):
        out = M.update_only(t, s, "k", update={"v": "t.v + s.v", "note": F.coalesce(F.col("s.note"), F.col("t.note"))},
                            strategy=strategy)
        assert rows(out) == [("a", 6, "x"), ("b", 2, "y")]


def test_matched_condition(spark):
    t = spark.createDataFrame([("a", 1, "run1"), ("b", 2, "run2")], SCHEMA)
    s = spark.createDataFrame([("a", 10, "run1"), ("b", 20, "run1")], SCHEMA)
    out = M.merge(t, s, "k", update={"v": "s.v"}, insert=None, matched_condition="t.note = s.note",
                  strategy="shuffle")
    assert rows(out) == [("a", 10, "run1"), ("b", 2, "run2")]


def test_source_conflicts(spark):
    s = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 3, None)], SCHEMA)
    assert [tuple(r) for r in M.source_conflicts(s, "k").collect()] == [("a", 2)]


def test_update_and_delete_where(spark):
    t = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", None, "y")], SCHEMA)
    upd = M.update_where(t, F.col("v") > 1, {"note": F.lit("big")})
    assert rows(upd) == [("a", 1, None), ("b", 2, "big"), ("c", None, "y")]
    # NULL predicate deletes nothing
    assert rows(M.delete_where(t, F.col("v") > 1)) == [("a", 1, None), ("c", None, "y")]


def test_replace_slice(spark):
    t = spark.createDataFrame([("r1", "v1", "c1"), ("r2", "v2", "c2")], "ingestion_id string, video_id string, comment_id string")
    new = spark.createDataFrame([("r1", "v1", "c9"), ("r1", "", "c8"), ("r1", "v1", "c9"), ("r1", "v1", None)],
                                "ingestion_id string, video_id string, comment_id string")
    out = M.replace_slice(t, "ingestion_id", new, new, ["video_id", "comment_id"], ["ingestion_id", "comment_id"])
    assert rows(out) == [("r1", "v1", "c9"), ("r2", "v2", "c2")]


def test_change_feed_roundtrip(spark):
    before = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "z")], SCHEMA)
    after = spark.createDataFrame([("a", 1, "x"), ("b", 2, "now"), ("d", 4, "d")], SCHEMA)
    cf = M.change_feed(before, after, "k")
    got = sorted((r.k, r._change_type) for r in cf.collect())
    assert got == [("b", "update_postimage"), ("b", "update_preimage"), ("c", "delete"), ("d", "insert")]
    # replaying the feed on `before` gives `after`
    ins = cf.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    dels = cf.where(F.col("_change_type") == "delete").select("k")
    replay = M.upsert(before.join(dels, "k", "left_anti"), ins, "k")
    assert rows(replay) == rows(after)


keys = st.sampled_from(["a", "b", "c", "d", "e"])
batch = st.lists(st.tuples(keys, st.integers(0, 100)), max_size=8, unique_by=lambda r: r[0])


@settings(max_examples=15, deadline=None)
@given(batch, batch)
def test_upsert_idempotent_and_plans_agree(spark, tgt, src):
    t = spark.createDataFrame([(k, v, "t") for k, v in tgt], SCHEMA)
    s = spark.createDataFrame([(k, v, "s") for k, v in src], SCHEMA)
    once = M.upsert(t, s, "k", strategy="broadcast")
    twice = M.upsert(once, s, "k", strategy="shuffle")
    assert rows(once) == rows(twice)
    expect = dict((k, (v, "t")) for k, v in tgt)
    expect.update((k, (v, "s")) for k, v in src)
    assert rows(once) == sorted((k, v, n) for k, (v, n) in expect.items())


@settings(max_examples=15, deadline=None)
@given(batch, batch)
def test_insert_only_never_changes_existing(spark, tgt, src):
    t = spark.createDataFrame([(k, v, "t") for k, v in tgt], SCHEMA)
    s = spark.createDataFrame([(k, v, "s") for k, v in src], SCHEMA)
    out = {r.k: (r.v, r.note) for r in M.insert_only(t, s, "k").collect()}
    for k, v in tgt:
        assert out[k] == (v, "t")
    assert set(out) == {k for k, _ in tgt} | {k for k, _ in src}


def test_repeated_source_keys_fail_when_asked(spark):
    import pytest

    t = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    s = spark.createDataFrame([("a", 2, "y"), ("a", 3, "z"), (None, 1, "n"), (None, 2, "n")], SCHEMA)
    with pytest.raises(Exception, match="repeats a key"):
        M.upsert(t, s, "k", check_keys=True).collect()
    assert M.upsert(t, s.where("v <> 3"), "k", check_keys=True).count() == 3
