"""Served datasets: presentation views, KPI counters, trends and latest tables.

Each function returns a lazy DataFrame; ``as_of`` is always a parameter (the
job edge passes the current time), never ``current_timestamp()`` inside.
Dimension lookups (videos, channels) are plain joins: adaptive execution
broadcasts a side whose real size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoledger.operators.dedupe import latest_per_key
from chronoledger.operators.timeseries import (calendar_spine, expand_spans, last_at_or_before, locf_spans,
                                               locf_spans_from_rollup, locf_spans_from_seed, total_by_day_from_spans)


def _ts(as_of):
    return F.lit(str(as_of)).cast("timestamp_ntz") if not hasattr(as_of, "_jc") else as_of


# -- views -----------------------------------------------------------------
def view_runs(runs: DataFrame) -> DataFrame:
    """Runs with ``duration_seconds`` (NULL while a run is open)."""
    return runs.select(
        "ingestion_id", "channel_name", "started_at", "ended_at", "status", "error_message",
        F.when(F.col("ended_at").isNotNull(),
               F.unix_timestamp("ended_at") - F.unix_timestamp("started_at")).alias("duration_seconds"),
    )


def view_targets(targets: DataFrame, state: DataFrame) -> DataFrame:
    """Configuration with current processing state (left join on the key)."""
    st = state.select("video_id", "status", "last_succeeded_at", "next_refresh_at",
                      "attempt_count", "error_message")
    return targets.select("video_id", "is_active", "priority", "refresh_interval_hours").join(
        st, "video_id", "left")


def view_video_metrics(snapshots: DataFrame, videos: DataFrame) -> DataFrame:
    """Video snapshots decorated with the *current* video row (left join)."""
    dim = videos.select(
        "video_id", F.col("title").alias("video_title"), "channel_id", "channel_title")
    return snapshots.join(dim, "video_id", "left").select(
        "video_id", "video_title", "channel_id", "channel_title", "collected_at",
        "view_count", "like_count", "comment_count", "ingestion_id")


def view_channel_metrics(snapshots: DataFrame, channels: DataFrame) -> DataFrame:
    """Channel snapshots decorated with the current channel title."""
    dim = channels.select("channel_id", F.col("title").alias("channel_title"))
    return snapshots.join(dim, "channel_id", "left").select(
        "channel_id", "channel_title", "collected_at", "view_count", "subscriber_count",
        "video_count", "ingestion_id")


# -- datasets --------------------------------------------------------------
def active_ids(targets: DataFrame) -> DataFrame:
    """DISTINCT ids of active targets."""
    return active_keys(targets).distinct()


def active_keys(targets: DataFrame) -> DataFrame:
    """Ids of active targets, for semi joins (which need no DISTINCT: the
    probe keeps a row once whatever the number of matches)."""
    return targets.where(F.col("is_active")).select("video_id")


def kpi_targets(targets: DataFrame, state: DataFrame) -> DataFrame:
    """Counters: active targets, active and FAILED, ever succeeded (any target)."""
    v = view_targets(targets, state)
    one = F.lit(1)
    return v.agg(
        F.sum(F.when(F.col("is_active"), one).otherwise(0)).cast("bigint").alias("active_videos"),
        F.sum(F.when(F.col("is_active") & (F.col("status") == "FAILED"), one).otherwise(0))
         .cast("bigint").alias("failed_videos"),
        F.sum(F.when(F.col("last_succeeded_at").isNotNull(), one).otherwise(0))
         .cast("bigint").alias("processed_videos"),
    )


def runs_recent(runs: DataFrame, as_of, days: int = 30, limit: int = 500) -> DataFrame:
    """Runs started in the last ``days`` days, newest first, at most ``limit``."""
    since = _ts(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    return (view_runs(runs).where(F.col("started_at") >= since)
            .orderBy(F.col("started_at").desc(), F.col("ingestion_id").desc())
            .limit(limit))


VIDEO_METRICS = ["view_count", "like_count", "comment_count"]
CHANNEL_METRICS = ["subscriber_count", "video_count"]


def _video_days(spans: DataFrame, videos: DataFrame) -> DataFrame:
    # titles are decorated per span (before the days are expanded)
    dim = videos.select("video_id", F.col("title").alias("video_title"), "channel_title")
    t = expand_spans(spans.join(dim, "video_id", "left"), VIDEO_METRICS, "collected_date")
    return t.select("video_id", "video_title", "channel_title", "collected_date", *VIDEO_METRICS)


def by_day(trend: DataFrame) -> DataFrame:
    """A trend in the order in which it is served: by day, then entity."""
    return trend.orderBy("collected_date", trend.columns[0])


def video_trend(targets: DataFrame, snapshots: DataFrame, videos: DataFrame, as_of,
                days: int = 90) -> DataFrame:
    """Daily LOCF of views, likes and comments for active videos.

    A day is kept only once the video has an observation and the latest
    observation's ``view_count`` is not NULL. ``by_day`` orders it.
    """
    obs = snapshots.join(active_keys(targets), "video_id", "left_semi")
    spans = locf_spans(obs, "video_id", "collected_at", ["ingestion_id"], VIDEO_METRICS, as_of, days,
                       require_not_null="view_count", name="collected_date")
    return _video_days(spans, videos)


def video_trend_from_rollup(targets: DataFrame, rollup: DataFrame, videos: DataFrame, as_of,
                            days: int = 90) -> DataFrame:
    """``video_trend`` read from a maintained ``daily_rollup`` of the video
    snapshots (one row per video and day) instead of every snapshot."""
    r = rollup.join(active_keys(targets), "video_id", "left_semi")
    spans = locf_spans_from_rollup(r, "video_id", as_of, days, require_not_null="view_count",
                                   name="collected_date")
    return _video_days(spans, videos)


def video_trend_from_seed(targets: DataFrame, rollup: DataFrame, seeds: DataFrame, videos: DataFrame, as_of,
                          days: int = 90) -> DataFrame:
    """``video_trend`` read from a rollup and its maintained seeds
    (``next_seed``): no day before the window's first month is read."""
    keys = active_keys(targets)
    spans = locf_spans_from_seed(rollup.join(keys, "video_id", "left_semi"), seeds.join(keys, "video_id", "left_semi"), "video_id",
                                 as_of, days, require_not_null="view_count", name="collected_date")
    return _video_days(spans, videos)


def active_channels(targets: DataFrame, snapshots: DataFrame, videos: DataFrame) -> DataFrame:
    """DISTINCT current channels of active videos that have snapshots."""
    seen = snapshots.select("video_id").distinct().join(active_keys(targets), "video_id", "left_semi")
    dim = videos.select("video_id", "channel_id")
    return seen.join(dim, "video_id", "left").select("channel_id").distinct()


def channel_trend(targets: DataFrame, video_snapshots: DataFrame, videos: DataFrame,
                  channel_snapshots: DataFrame, channels: DataFrame, as_of,
                  days: int = 90) -> DataFrame:
    """Daily LOCF of subscribers and video counts for channels having an
    active video; days whose latest ``subscriber_count`` is NULL are dropped."""
    act = active_channels(targets, video_snapshots, videos).where(F.col("channel_id").isNotNull())
    obs = channel_snapshots.join(act, "channel_id", "left_semi")
    spans = locf_spans(obs, "channel_id", "collected_at", ["ingestion_id"], CHANNEL_METRICS, as_of, days,
                       require_not_null="subscriber_count", name="collected_date")
    dim = channels.select("channel_id", F.col("title").alias("channel_title"))
    t = expand_spans(spans.join(dim, "channel_id", "left"), CHANNEL_METRICS, "collected_date")
    return t.select("channel_id", "channel_title", "collected_date", *CHANNEL_METRICS)


def latest_videos(targets: DataFrame, snapshots: DataFrame, videos: DataFrame) -> DataFrame:
    """Latest snapshot per active video (ties broken by run id), most viewed first."""
    obs = snapshots.join(active_keys(targets), "video_id", "left_semi")
    last = latest_per_key(obs, "video_id", ["collected_at", "ingestion_id"])
    dim = videos.select("video_id", F.col("title").alias("video_title"),
                                           "channel_title")
    return (last.join(dim, "video_id", "left")
            .select("video_id", "video_title", "channel_title", "collected_at",
                    "view_count", "like_count", "comment_count")
            .orderBy(F.col("view_count").desc_nulls_last(), F.col("video_id")))


def latest_by_group(snapshots: DataFrame, key: str = "video_id") -> DataFrame:
    """Arg-max per entity: the latest row's values, even when they are NULL."""
    return latest_per_key(snapshots, key, ["collected_at", "ingestion_id"])


def views_total_by_day(targets: DataFrame, snapshots: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Total views of active videos per day, from the trend's LOCF spans
    (no per-(video, day) rows are materialised)."""
    obs = snapshots.join(active_keys(targets), "video_id", "left_semi")
    spans = locf_spans(obs, "video_id", "collected_at", ["ingestion_id"], ["view_count"], as_of, days,
                       require_not_null="view_count", name="collected_date")
    return total_by_day_from_spans(spans, "view_count", "total_views", "collected_date").orderBy("collected_date")


def subscribers_total_by_day(targets: DataFrame, video_snapshots: DataFrame, videos: DataFrame,
                             channel_snapshots: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Total subscribers of channels with an active video, per day."""
    act = active_channels(targets, video_snapshots, videos).where(F.col("channel_id").isNotNull())
    obs = channel_snapshots.join(act, "channel_id", "left_semi")
    spans = locf_spans(obs, "channel_id", "collected_at", ["ingestion_id"], ["subscriber_count"], as_of, days,
                       require_not_null="subscriber_count", name="collected_date")
    return total_by_day_from_spans(spans, "subscriber_count", "total_subscribers", "collected_date").orderBy("collected_date")


def video_calendar_spine(targets: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Every (active video, day) of the window."""
    return calendar_spine(active_ids(targets), "video_id", as_of, days, "collected_date")


def range_join_history(targets: DataFrame, snapshots: DataFrame, as_of, days: int = 90) -> DataFrame:
    """For every active video and day: the latest snapshot taken before the
    end of the day (run id, time, views), NULL before the first one."""
    return last_at_or_before(active_ids(targets), snapshots, "video_id", "collected_at",
                             ["ingestion_id"], ["ingestion_id", "collected_at", "view_count"],
                             as_of, days, "collected_date")


def entity_history(snapshots: DataFrame, videos: DataFrame, ids: DataFrame) -> DataFrame:
    """Snapshot history (with current titles) of the videos listed in ``ids``."""
    m = view_video_metrics(snapshots.join(ids.select("video_id").distinct(), "video_id", "left_semi"),
                           videos)
    return m.orderBy("video_id", "collected_at", "ingestion_id")


def register_views(tables: dict, prefix: str = "dashboard_") -> list[str]:
    """``CREATE OR REPLACE`` the four presentation views as temp views over
    the given tables (runs with duration, targets with state, video and
    channel metric history)."""
    views = {
        "ingestion_runs": view_runs(tables["ingestion_runs"]),
        "video_targets": view_targets(tables["video_targets"], tables["video_processing_state"]),
        "video_metrics": view_video_metrics(tables["video_snapshots"], tables["videos"]),
        "channel_metrics": view_channel_metrics(tables["channel_snapshots"], tables["channels"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
