"""Set-based roll-up of step outcomes to target and run status."""

import datetime as dt

from chronoledger import schemas as S
from chronoledger.operators import outcomes as OC

T = dt.datetime(2024, 1, 1)


def test_rollup_cases(spark):
    owned = spark.createDataFrame(
        [("r", v, 24) for v in ("ok", "missing", "notfound", "blank", "none")],
        "ingestion_id string, video_id string, refresh_interval_hours int")
    rows = [("r", "ok", s, "SUCCESS", T, None) for s in S.FETCH_STEPS]
    rows += [("r", "missing", "fetch_videos", "SUCCESS", T, None)]
    rows += [("r", "notfound", "fetch_videos", "NOT_FOUND", T, "gone")]
    rows += [("r", "blank", "fetch_videos", "SUCCESS", T, None), ("r", "blank", "fetch_channels", "FAILED", T, ""),
             ("r", "blank", "fetch_comments", "FAILED", T, "quota"), ("r", "blank", "fetch_replies", "SUCCESS", T, None)]
    outs = spark.createDataFrame(rows, S.INGESTION_STEP_OUTCOMES)
    fin = {r.video_id: (r.status, r.error_message) for r in OC.finalize_targets(owned, outs).collect()}
    d = S.MSG_STEP_NOT_DONE
    assert fin["ok"] == ("SUCCESS", None)
    assert fin["notfound"] == ("NOT_FOUND", "gone")
    assert fin["missing"] == ("FAILED", f"fetch_channels: {d}; fetch_comments: {d}; fetch_replies: {d}")
    assert fin["blank"] == ("FAILED", f"fetch_channels: {d}; fetch_comments: quota")
    assert fin["none"][0] == "FAILED" and fin["none"][1].startswith(f"fetch_videos: {d}; ")
    runs = OC.finalize_runs(OC.finalize_targets(owned, outs)).collect()
    assert [(r.status, r.targets, r.failed) for r in runs] == [("PARTIAL_SUCCESS", 5, 4)]


def test_found_and_parent_outcomes(spark):
    req = spark.createDataFrame([("r", "v77"), ("r", "v78"), ("s", "v77")], "ingestion_id string, video_id string")
    ret = spark.createDataFrame([("r", "v77"), ("r", "v77"), ("r", "other")], "ingestion_id string, video_id string")
    got = {(r.ingestion_id, r.video_id): (r.status, r.error_message) for r in
           OC.found_outcomes(req, ret, "video_id", "fetch_videos", "NOT_FOUND", S.MSG_VIDEO_NOT_FOUND).collect()}
    assert got == {("r", "v77"): ("SUCCESS", None), ("r", "v78"): ("NOT_FOUND", S.MSG_VIDEO_NOT_FOUND),
                   ("s", "v77"): ("NOT_FOUND", S.MSG_VIDEO_NOT_FOUND)}
    vc = spark.createDataFrame([("r", "v1", "c1"), ("r", "v2", None), ("r", "v3", "c3")],
                               "ingestion_id string, video_id string, channel_id string")
    back = spark.createDataFrame([("r", "c1")], "ingestion_id string, channel_id string")
    got = {r.video_id: r.status for r in OC.parent_outcomes(vc, back).collect()}
    assert got == {"v1": "SUCCESS", "v2": "FAILED", "v3": "FAILED"}


def test_children_keep_empty_parents(spark):
    outs = spark.createDataFrame([("r", "v1", "fetch_comments", "SUCCESS", T, None),
                                  ("r", "v2", "fetch_comments", "SUCCESS", T, None),
                                  ("r", "v3", "fetch_comments", "FAILED", T, "x")], S.INGESTION_STEP_OUTCOMES)
    hand = spark.createDataFrame([("r", "v1", "c1"), ("old", "v2", "c9")], S.INGESTION_COMMENTS)
    got = sorted((r.video_id, r.comment_id) for r in OC.children_by_parent(hand, outs).collect())
    assert got == [("v1", "c1"), ("v2", None)]


def test_comment_outcomes_per_run_and_video(spark):
    videos = spark.createDataFrame([("r", "ok"), ("r", "disabled"), ("r", "quota"), ("r2", "quota")],
                                   "ingestion_id string, video_id string")
    fails = spark.createDataFrame([
        ("r", "disabled", T, 1, 403, '{"error":{"reason":"commentsDisabled"}}'),
        ("r", "quota", T, 2, 403, '{"error":{"errors":[{"reason":"quotaExceeded"}]}}'),
        ("r", "quota", dt.datetime(2024, 1, 2), 3, 500, ""),  # later failure: the first one counts
    ], "ingestion_id string, video_id string, ts timestamp_ntz, attempt_id bigint, status_code int, body string")
    got = {(r.ingestion_id, r.video_id): (r.status, r.category) for r in
           OC.comment_outcomes(videos, fails, ["ingestion_id", "video_id"]).collect()}
    assert got == {("r", "ok"): ("SUCCESS", None), ("r", "disabled"): ("SUCCESS", "COMMENTS_DISABLED"),
                   ("r", "quota"): ("FAILED", "QUOTA_EXCEEDED"), ("r2", "quota"): ("SUCCESS", None)}
