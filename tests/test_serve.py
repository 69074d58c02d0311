"""Served datasets: bounded windows, active-only rules, KPI semantics."""

import datetime as dt
import inspect

from chronoledger import schemas as S
from chronoledger.plans import serve

T = dt.datetime


def test_dataset_bounds_are_the_served_ones():
    assert inspect.signature(serve.runs_recent).parameters["days"].default == 30
    assert inspect.signature(serve.runs_recent).parameters["limit"].default == 500
    # 90 calendar days = today and the 89 before it
    assert inspect.signature(serve.video_trend).parameters["days"].default == 90
    assert inspect.signature(serve.channel_trend).parameters["days"].default == 90


def _targets(spark, rows):
    return spark.createDataFrame([(v, a, 1, 24, T(2024, 1, 1), T(2024, 1, 1)) for v, a in rows], S.VIDEO_TARGETS)


def _state(spark, rows):
    return spark.createDataFrame([(v, st, None, None, None, succ, None, 1, "r", None) for v, st, succ in rows],
                                 S.VIDEO_PROCESSING_STATE)


def test_kpis(spark):
    t = _targets(spark, [("a", True), ("b", True), ("c", False)])
    s = _state(spark, [("a", "FAILED", None), ("c", "FAILED", T(2024, 1, 2)), ("b", "SUCCESS", T(2024, 1, 3))])
    k = serve.kpi_targets(t, s).collect()[0]
    # failed counts active targets only; processed counts inactive targets too
    assert (k.active_videos, k.failed_videos, k.processed_videos) == (2, 1, 2)
    empty = serve.kpi_targets(t.where("false"), s).collect()[0]
    assert empty.active_videos is None  # SUM over zero rows


def _snaps(spark, rows):
    return spark.createDataFrame(rows, S.VIDEO_SNAPSHOTS)


def _videos(spark, ids):
    return spark.createDataFrame([(v, "ch", "Ch", f"title {v}", None, None, None, [], None, None, None, 0, None,
                                   None, None, T(2024, 1, 1)) for v in ids], S.VIDEOS)


def test_latest_and_trend_active_only(spark):
    t = _targets(spark, [("a", True), ("b", False)])
    snaps = _snaps(spark, [("a", "r1", T(2024, 1, 1, 1), 5, 1, 1), ("a", "r2", T(2024, 1, 2, 1), 9, 1, 1),
                           ("b", "r1", T(2024, 1, 1, 1), 7, 1, 1)])
    v = _videos(spark, ["a", "b"])
    latest = serve.latest_videos(t, snaps, v).collect()
    assert [(r.video_id, r.view_count, r.video_title) for r in latest] == [("a", 9, "title a")]
    trend = serve.video_trend(t, snaps, v, "2024-01-03", 3).orderBy("collected_date").collect()
    assert [(r.video_id, str(r.collected_date), r.view_count) for r in trend] == [
        ("a", "2024-01-01", 5), ("a", "2024-01-02", 9), ("a", "2024-01-03", 9)]


def test_runs_recent_window_and_order(spark):
    runs = spark.createDataFrame([
        ("old", "s", None, T(2024, 1, 1), None, "RUNNING", None),
        ("r1", "s", None, T(2024, 3, 1), T(2024, 3, 1, 0, 1), "SUCCESS", None),
        ("r2", "s", None, T(2024, 3, 2), None, "RUNNING", None),
    ], S.INGESTION_RUNS)
    got = [(r.ingestion_id, r.duration_seconds) for r in serve.runs_recent(runs, "2024-03-10 00:00:00").collect()]
    assert got == [("r2", None), ("r1", 60)]
