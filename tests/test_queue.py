"""Due queue: parameter validation, eligibility edges, claim order, claim/finish merges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.operators import queue as Q

NOW = "2024-05-01 12:00:00"


def test_validate_limit():
    assert Q.validate_limit("0", "x") == 0
    assert Q.validate_limit("15", "x") == 15
    for bad in ("-1", "invalid"):
        with pytest.raises(ValueError):
            Q.validate_limit(bad, "x")
    with pytest.raises(ValueError):
        Q.validate_limit("0", "batch_size", allow_zero=False)


def _ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def _targets(spark, ids, active=True, prio=1):
    rows = [(i, active, prio, 24, _ts("2024-01-01 00:00:00"), _ts("2024-01-01 00:00:00")) for i in ids]
    return spark.createDataFrame(rows, S.VIDEO_TARGETS)


def _state(spark, rows):
    full = [(vid, status, None, _ts(claimed), None, _ts(succ), _ts(nxt), 1, "r0", None)
            for vid, status, claimed, succ, nxt in rows]
    return spark.createDataFrame(full, S.VIDEO_PROCESSING_STATE)


def test_due_edges(spark):
    t = _targets(spark, ["new", "due_null", "due_eq", "later", "claim_2h", "claim_2h1s", "inactive"])
    t = t.withColumn("is_active", F.col("video_id") != "inactive")
    s = _state(spark, [
        ("due_null", "SUCCESS", None, "2024-04-01 00:00:00", None),
        ("due_eq", "FAILED", None, None, NOW),
        ("later", "SUCCESS", None, "2024-04-01 00:00:00", "2024-05-01 12:00:01"),
        ("claim_2h", "PROCESSING", "2024-05-01 10:00:00", None, None),
        ("claim_2h1s", "PROCESSING", "2024-05-01 09:59:59", None, None),
        ("inactive", "SUCCESS", None, None, None),
    ])
    due = {r.video_id for r in Q.due_targets(t, s, NOW).collect()}
    assert due == {"new", "due_null", "due_eq", "claim_2h1s"}
    stale = {r.video_id for r in Q.stale_claims(s, NOW).collect()}
    assert stale == {"claim_2h1s"}


def test_claim_order_and_limit(spark):
    t = spark.createDataFrame([
        ("a", True, 1, 24, _ts("2024-01-01 00:00:00"), _ts("2024-01-01 00:00:00")),
        ("b", True, 5, 24, _ts("2024-01-01 00:00:00"), _ts("2024-01-01 00:00:00")),
        ("c", True, 5, 24, _ts("2024-01-01 00:00:00"), _ts("2024-01-01 00:00:00")),
        ("d", True, 9, 24, _ts("2024-01-01 00:00:00"), _ts("2024-01-01 00:00:00")),
    ], S.VIDEO_TARGETS)
    # d succeeded before (goes last despite priority); b has a refresh time, c has none (NULLS FIRST)
    s = _state(spark, [("d", "SUCCESS", None, "2024-04-01 00:00:00", None),
                       ("b", "FAILED", None, None, "2024-04-30 00:00:00")])
    got = [r.video_id for r in Q.claim_due(t, s, NOW, 3).collect()]
    assert got == ["c", "b", "a"]


def test_claim_and_finish_merges(spark):
    s = _state(spark, [("a", "FAILED", None, None, None)]).withColumn("error_message", F.lit("boom"))
    claimed = spark.createDataFrame([("a",), ("n",)], "video_id string")
    st = {r.video_id: r for r in Q.claim_merge(s, claimed, "run9", NOW).collect()}
    assert st["a"].status == "PROCESSING" and st["a"].attempt_count == 2 and st["a"].error_message is None
    assert st["n"].attempt_count == 1 and st["n"].last_ingestion_id == "run9"
    fin = spark.createDataFrame([("a", "run9", "SUCCESS", None, 24), ("n", "run9", "FAILED", "x", 48),
                                 ("zz", "run9", "SUCCESS", None, 1)],
                                "video_id string, ingestion_id string, status string, error_message string, refresh_interval_hours int")
    after = Q.finish_targets_merge(Q.claim_merge(s, claimed, "run9", NOW), fin, "2024-05-02 00:00:00")
    got = {r.video_id: r for r in after.collect()}
    assert set(got) == {"a", "n"}  # unmatched source rows ignored
    a, n = got["a"], got["n"]
    assert a.status == "SUCCESS" and a.claimed_at is None and a.first_processed_at == _ts("2024-05-02 00:00:00")
    assert a.next_refresh_at == _ts("2024-05-03 00:00:00") and a.attempt_count == 2
    assert n.status == "FAILED" and n.last_succeeded_at is None and n.first_processed_at is None
    assert n.next_refresh_at == _ts("2024-05-04 00:00:00") and n.error_message == "x"


def test_request_batches_51(spark):
    ids = spark.createDataFrame([(f"id{i:03d}",) for i in range(51)], "video_id string")
    b = Q.request_batches(ids, "video_id", F.lit(0), 50).collect()
    assert sorted(r.n_ids for r in b) == [1, 50]
    assert sum(len(r.ids.split(",")) for r in b) == 51


def test_finish_run_keeps_channel_name(spark):
    runs = spark.createDataFrame([("r1", "src", "Old", _ts(NOW), None, "RUNNING", "e")], S.INGESTION_RUNS)
    fin = spark.createDataFrame([("r1", "SUCCESS", None, None)],
                                "ingestion_id string, status string, error_message string, channel_name string")
    r = Q.finish_runs_merge(runs, fin, "2024-05-02 00:00:00").collect()[0]
    assert r.channel_name == "Old" and r.status == "SUCCESS" and r.error_message is None
    assert r.ended_at == _ts("2024-05-02 00:00:00")
