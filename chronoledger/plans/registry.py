"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver's test tables through the stand-ins in
``sources.standins`` and runs one engine operator or served dataset over the
whole tables. ``ORACLE[name]`` is the independent DuckDB SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.plans import oracle as O
from chronoledger.plans import serve
from chronoledger.sources import standins as SI

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra: list[tuple[str, str]] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.with_ctes(sql, extra)
        return fn
    return deco


TREND_AS_OF = SI.AS_OF_TREND
TREND_DAYS = 90


# ---------------------------------------------------------------- serving
VT_SQL = """SELECT a.video_id, max(m.video_title) AS video_title, max(m.channel_title) AS channel_title, d.collected_date,
  arg_max_null(m.view_count, (m.collected_at, m.ingestion_id)) AS view_count,
  arg_max_null(m.like_count, (m.collected_at, m.ingestion_id)) AS like_count,
  arg_max_null(m.comment_count, (m.collected_at, m.ingestion_id)) AS comment_count
FROM d CROSS JOIN active a
LEFT JOIN vmetrics m ON m.video_id = a.video_id AND m.collected_at < d.collected_date + INTERVAL 1 DAY
GROUP BY a.video_id, d.collected_date
HAVING arg_max_null(m.view_count, (m.collected_at, m.ingestion_id)) IS NOT NULL"""

CT_SQL = """SELECT a.channel_id, max(m.channel_title) AS channel_title, d.collected_date,
  arg_max_null(m.subscriber_count, (m.collected_at, m.ingestion_id)) AS subscriber_count,
  arg_max_null(m.video_count, (m.collected_at, m.ingestion_id)) AS video_count
FROM d CROSS JOIN ac a
LEFT JOIN cmetrics m ON m.channel_id = a.channel_id AND m.collected_at < d.collected_date + INTERVAL 1 DAY
GROUP BY a.channel_id, d.collected_date
HAVING arg_max_null(m.subscriber_count, (m.collected_at, m.ingestion_id)) IS NOT NULL"""

AC_SQL = """SELECT DISTINCT m.channel_id FROM vmetrics m JOIN targets t ON m.video_id = t.video_id WHERE t.is_active"""
CAL90 = ("d", O.calendar_sql(TREND_AS_OF, TREND_DAYS))


def _trend_tables(spark, d):
    return (SI.targets(spark, d), SI.video_snapshots(spark, d), SI.videos(spark, d))


def _channel_trend(spark, d):
    t, vs, v = _trend_tables(spark, d)
    return serve.channel_trend(t, vs, v, SI.channel_snapshots(spark, d), SI.channels(spark, d),
                               TREND_AS_OF, TREND_DAYS)


@register("video_trend", VT_SQL, [CAL90])
def q_video_trend(spark, d):
    return serve.video_trend(SI.targets(spark, d), SI.video_snapshots(spark, d),
                             SI.videos(spark, d), TREND_AS_OF, TREND_DAYS)


@register("video_trend_rollup", VT_SQL, [CAL90])
def q_video_trend_rollup(spark, d):
    """The flagship trend from a daily-last rollup of the snapshots."""
    from chronoledger.operators.timeseries import daily_rollup
    rollup = daily_rollup(SI.video_snapshots(spark, d), "video_id", "collected_at", ["ingestion_id"],
                          ["view_count", "like_count", "comment_count"], name="collected_date")
    return serve.video_trend_from_rollup(SI.targets(spark, d), rollup, SI.videos(spark, d),
                                         TREND_AS_OF, TREND_DAYS)


@register("video_trend_seeded", VT_SQL, [CAL90])
def q_video_trend_seeded(spark, d):
    """The flagship trend from a rollup and the seed of its first month, itself
    made from the seed of an earlier month and the days between."""
    from chronoledger.operators.timeseries import daily_rollup, next_seed, seed_day
    name = "collected_date"
    rollup = daily_rollup(SI.video_snapshots(spark, d), "video_id", "collected_at", ["ingestion_id"], serve.VIDEO_METRICS, name=name)
    day = seed_day(TREND_AS_OF, TREND_DAYS)
    before = day.replace(year=day.year - 1)
    seeds = next_seed(next_seed(None, rollup, "video_id", None, before, name), rollup, "video_id", before, day, name)
    return serve.video_trend_from_seed(SI.targets(spark, d), rollup, seeds, SI.videos(spark, d), TREND_AS_OF, TREND_DAYS)


@register("video_trend_by_day", VT_SQL + "\nORDER BY d.collected_date, a.video_id", [CAL90])
def q_video_trend_by_day(spark, d):
    """The flagship trend in the order in which it is served."""
    return serve.by_day(q_video_trend(spark, d))


@register("channel_trend", CT_SQL, [("ac", AC_SQL), CAL90])
def q_channel_trend(spark, d):
    return _channel_trend(spark, d)


@register("views_total_by_day",
          f"SELECT collected_date, CAST(sum(view_count) AS BIGINT) AS total_views FROM ({VT_SQL}) x GROUP BY collected_date",
          [CAL90])
def q_views_total_by_day(spark, d):
    return serve.views_total_by_day(SI.targets(spark, d), SI.video_snapshots(spark, d), TREND_AS_OF, TREND_DAYS)


@register("subscribers_total_by_day",
          f"SELECT collected_date, CAST(sum(subscriber_count) AS BIGINT) AS total_subscribers FROM ({CT_SQL}) x GROUP BY collected_date",
          [("ac", AC_SQL), CAL90])
def q_subscribers_total_by_day(spark, d):
    t, vs, v = _trend_tables(spark, d)
    return serve.subscribers_total_by_day(t, vs, v, SI.channel_snapshots(spark, d), TREND_AS_OF, TREND_DAYS)


@register("calendar_spine", "SELECT a.video_id, d.collected_date FROM d CROSS JOIN active a", [CAL90])
def q_calendar_spine(spark, d):
    return serve.video_calendar_spine(SI.targets(spark, d), TREND_AS_OF, TREND_DAYS)


@register("range_join_history", """
SELECT a.video_id, d.collected_date,
  arg_max_null(m.ingestion_id, (m.collected_at, m.ingestion_id)) AS ingestion_id,
  arg_max_null(m.collected_at, (m.collected_at, m.ingestion_id)) AS collected_at,
  arg_max_null(m.view_count, (m.collected_at, m.ingestion_id)) AS view_count
FROM d CROSS JOIN active a
LEFT JOIN vsnap m ON m.video_id = a.video_id AND m.collected_at < d.collected_date + INTERVAL 1 DAY
GROUP BY a.video_id, d.collected_date""", [("d", O.calendar_sql(TREND_AS_OF, TREND_DAYS))])
def q_range_join_history(spark, d):
    return serve.range_join_history(SI.targets(spark, d), SI.video_snapshots(spark, d),
                                    TREND_AS_OF, TREND_DAYS)


@register("latest_by_group", """
SELECT video_id, ingestion_id, collected_at, view_count, like_count, comment_count FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY video_id ORDER BY collected_at DESC, ingestion_id DESC) AS rn
  FROM vsnap) x WHERE rn = 1""")
def q_latest_by_group(spark, d):
    return serve.latest_by_group(SI.video_snapshots(spark, d))


@register("latest_videos", """
SELECT video_id, video_title, channel_title, collected_at, view_count, like_count, comment_count FROM (
  SELECT m.*, ROW_NUMBER() OVER (PARTITION BY m.video_id ORDER BY m.collected_at DESC, m.ingestion_id DESC) AS rn
  FROM vmetrics m JOIN targets t ON m.video_id = t.video_id WHERE t.is_active) x WHERE rn = 1""")
def q_latest_videos(spark, d):
    return serve.latest_videos(*_trend_tables(spark, d))


@register("active_channels", AC_SQL)
def q_active_channels(spark, d):
    return serve.active_channels(*_trend_tables(spark, d))


@register("view_video_metrics", "SELECT * FROM vmetrics")
def q_view_video_metrics(spark, d):
    return serve.view_video_metrics(SI.video_snapshots(spark, d), SI.videos(spark, d))


@register("view_channel_metrics", "SELECT * FROM cmetrics")
def q_view_channel_metrics(spark, d):
    return serve.view_channel_metrics(SI.channel_snapshots(spark, d), SI.channels(spark, d))


@register("entity_history", """
SELECT m.* FROM vmetrics m WHERE m.video_id IN (SELECT video_id FROM owned)""")
def q_entity_history(spark, d):
    from chronoledger.operators.queue import owned_targets
    owned = owned_targets(SI.targets(spark, d), SI.state(spark, d))
    return serve.entity_history(SI.video_snapshots(spark, d), SI.videos(spark, d), owned)


@register("view_targets", "SELECT * FROM vtargets")
def q_view_targets(spark, d):
    return serve.view_targets(SI.targets(spark, d), SI.state(spark, d))


@register("kpi_targets", """
SELECT CAST(sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS BIGINT) AS active_videos,
  CAST(sum(CASE WHEN is_active AND status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_videos,
  CAST(sum(CASE WHEN last_succeeded_at IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS processed_videos
FROM vtargets""")
def q_kpi_targets(spark, d):
    return serve.kpi_targets(SI.targets(spark, d), SI.state(spark, d))


@register("distinct_active", "SELECT * FROM active")
def q_distinct_active(spark, d):
    return serve.active_ids(SI.targets(spark, d))


VIEW_RUNS_SQL = """SELECT ingestion_id, channel_name, started_at, ended_at, status, error_message,
  CASE WHEN ended_at IS NOT NULL THEN CAST(epoch(ended_at) - epoch(started_at) AS BIGINT) END AS duration_seconds
FROM runs"""
RUNS_AS_OF = SI.AS_OF_RUNS
RUNS_LIMIT = 100


@register("view_runs", VIEW_RUNS_SQL)
def q_view_runs(spark, d):
    return serve.view_runs(SI.runs(spark, d))


@register("runs_recent", f"""SELECT * FROM ({VIEW_RUNS_SQL}) v
WHERE started_at >= TIMESTAMP '{RUNS_AS_OF}' - INTERVAL 30 DAYS
ORDER BY started_at DESC, ingestion_id DESC LIMIT {RUNS_LIMIT}""")
def q_runs_recent(spark, d):
    return serve.runs_recent(SI.runs(spark, d), RUNS_AS_OF, 30, RUNS_LIMIT)


@register("local_time", """SELECT ingestion_id,
  (started_at AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS started_at_local,
  (ended_at AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo' AS ended_at_local
FROM runs""")
def q_local_time(spark, d):
    from chronoledger.functions.columns import utc_to_local
    r = SI.runs(spark, d)
    return r.select("ingestion_id", utc_to_local("started_at", "America/Sao_Paulo").alias("started_at_local"),
                    utc_to_local("ended_at", "America/Sao_Paulo").alias("ended_at_local"))


# ---------------------------------------------------------------- queue
QUEUE_AS_OF = SI.AS_OF_QUEUE
BATCH = 20
DUE_SQL = f"""SELECT t.video_id, t.refresh_interval_hours FROM targets t LEFT JOIN state s ON t.video_id = s.video_id
WHERE t.is_active AND (s.video_id IS NULL
  OR (s.status <> 'PROCESSING' AND (s.next_refresh_at IS NULL OR s.next_refresh_at <= TIMESTAMP '{QUEUE_AS_OF}'))
  OR (s.status = 'PROCESSING' AND s.claimed_at < TIMESTAMP '{QUEUE_AS_OF}' - INTERVAL 2 HOURS))
ORDER BY CASE WHEN s.last_succeeded_at IS NULL THEN 0 ELSE 1 END, t.priority DESC,
  s.next_refresh_at ASC NULLS FIRST, t.video_id LIMIT {BATCH}"""


@register("claim_due", DUE_SQL)
def q_claim_due(spark, d):
    from chronoledger.operators.queue import claim_due
    return claim_due(SI.targets(spark, d), SI.state(spark, d), QUEUE_AS_OF, BATCH)


@register("stale_claims", f"""SELECT * FROM state
WHERE status = 'PROCESSING' AND claimed_at < TIMESTAMP '{QUEUE_AS_OF}' - INTERVAL 2 HOURS""")
def q_stale_claims(spark, d):
    from chronoledger.operators.queue import stale_claims
    return stale_claims(SI.state(spark, d), QUEUE_AS_OF)


@register("owned_targets", "SELECT * FROM owned")
def q_owned_targets(spark, d):
    from chronoledger.operators.queue import owned_targets
    return owned_targets(SI.targets(spark, d), SI.state(spark, d))


@register("next_refresh", """SELECT s.video_id, s.last_attempt_at + to_hours(CAST(t.refresh_interval_hours AS BIGINT)) AS next_refresh_at
FROM state s JOIN targets t ON s.video_id = t.video_id""")
def q_next_refresh(spark, d):
    from chronoledger.operators.queue import next_refresh
    s, t = SI.state(spark, d), SI.targets(spark, d)
    return s.join(t.select("video_id", "refresh_interval_hours"), "video_id").select(
        "video_id", next_refresh("last_attempt_at", "refresh_interval_hours").alias("next_refresh_at"))


@register("semi_join_ids", """SELECT video_id, channel_id, title, view_count FROM videos
WHERE video_id IN (SELECT video_id FROM owned)""")
def q_semi_join_ids(spark, d):
    from chronoledger.operators.queue import owned_targets
    ids = owned_targets(SI.targets(spark, d), SI.state(spark, d)).select("video_id")
    return SI.videos(spark, d).join(ids, "video_id", "left_semi").select(
        "video_id", "channel_id", "title", "view_count")


@register("request_batches", """SELECT bucket, batch_no, count(*) AS n_ids, string_agg(video_id, ',' ORDER BY video_id) AS ids
FROM (SELECT video_id, CAST(video_id AS BIGINT) // 1000 AS bucket,
        CAST((ROW_NUMBER() OVER (PARTITION BY CAST(video_id AS BIGINT) // 1000 ORDER BY video_id) - 1) // 50 AS BIGINT) AS batch_no
      FROM targets) x GROUP BY bucket, batch_no""")
def q_request_batches(spark, d):
    from chronoledger.operators.queue import request_batches
    # ranges of a thousand ids: as many buckets as the ids need
    return request_batches(SI.targets(spark, d), "video_id", F.floor(F.col("video_id").cast("bigint") / 1000), 50)


@register("merge_claim", f"""WITH c AS ({DUE_SQL})
SELECT COALESCE(s.video_id, c.video_id) AS video_id,
  CASE WHEN c.video_id IS NOT NULL THEN 'PROCESSING' ELSE s.status END AS status,
  s.first_processed_at,
  CASE WHEN c.video_id IS NOT NULL THEN TIMESTAMP '{QUEUE_AS_OF}' ELSE s.claimed_at END AS claimed_at,
  CASE WHEN c.video_id IS NOT NULL THEN TIMESTAMP '{QUEUE_AS_OF}' ELSE s.last_attempt_at END AS last_attempt_at,
  s.last_succeeded_at, s.next_refresh_at,
  CASE WHEN c.video_id IS NULL THEN s.attempt_count WHEN s.video_id IS NULL THEN 1 ELSE s.attempt_count + 1 END AS attempt_count,
  CASE WHEN c.video_id IS NOT NULL THEN 'claim-run' ELSE s.last_ingestion_id END AS last_ingestion_id,
  CASE WHEN c.video_id IS NOT NULL THEN NULL ELSE s.error_message END AS error_message
FROM state s FULL OUTER JOIN c ON s.video_id = c.video_id""")
def q_merge_claim(spark, d):
    from chronoledger.operators.queue import claim_due, claim_merge
    t, s = SI.targets(spark, d), SI.state(spark, d)
    claimed = claim_due(t, s, QUEUE_AS_OF, BATCH)
    return claim_merge(s, claimed, "claim-run", QUEUE_AS_OF)


# ---------------------------------------------------------------- outcomes
@register("succeeded_entities", """SELECT o.* FROM owned o
WHERE EXISTS (SELECT 1 FROM outcomes x WHERE x.ingestion_id = o.ingestion_id AND x.video_id = o.video_id
  AND x.step = 'fetch_videos' AND x.status = 'SUCCESS')""")
def q_succeeded_entities(spark, d):
    from chronoledger.operators.outcomes import succeeded_entities
    from chronoledger.operators.queue import owned_targets
    return succeeded_entities(owned_targets(SI.targets(spark, d), SI.state(spark, d)), SI.outcomes(spark, d))


RETURNED_VIDEOS_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS video_id FROM customer WHERE c_acctbal >= 0"


def _returned_videos(spark, d, owned):
    """Videos the source returned for each owned run: those with a
    non-negative balance stand in for ids the API still knows."""
    from chronoledger.sources.tables import load
    c = load(spark, d, "customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("video_id"))
    return owned.select("ingestion_id", "video_id").join(c, "video_id", "left_semi")


@register("missing_entities", f"""SELECT o.ingestion_id, o.video_id FROM owned o
WHERE o.video_id NOT IN ({RETURNED_VIDEOS_SQL})""")
def q_missing_entities(spark, d):
    from chronoledger.operators.outcomes import missing_entities
    from chronoledger.operators.queue import owned_targets
    owned = owned_targets(SI.targets(spark, d), SI.state(spark, d)).select("ingestion_id", "video_id")
    return missing_entities(owned, _returned_videos(spark, d, owned), ["ingestion_id", "video_id"])


@register("video_outcomes", f"""SELECT o.ingestion_id, o.video_id, 'fetch_videos' AS step,
  CASE WHEN r.video_id IS NOT NULL THEN 'SUCCESS' ELSE 'NOT_FOUND' END AS status,
  TIMESTAMP '{QUEUE_AS_OF}' AS completed_at,
  CASE WHEN r.video_id IS NULL THEN 'Vídeo não encontrado ou não está acessível' END AS error_message
FROM owned o LEFT JOIN ({RETURNED_VIDEOS_SQL}) r ON o.video_id = r.video_id""")
def q_video_outcomes(spark, d):
    from chronoledger import schemas as S
    from chronoledger.operators.outcomes import found_outcomes
    from chronoledger.operators.queue import owned_targets
    owned = owned_targets(SI.targets(spark, d), SI.state(spark, d))
    return found_outcomes(owned, _returned_videos(spark, d, owned), "video_id", "fetch_videos",
                          S.ST_NOT_FOUND, S.MSG_VIDEO_NOT_FOUND, QUEUE_AS_OF)


PARENT_SQL = """SELECT o.ingestion_id, o.video_id, v.channel_id FROM owned o JOIN videos v ON o.video_id = v.video_id
WHERE EXISTS (SELECT 1 FROM outcomes x WHERE x.ingestion_id = o.ingestion_id AND x.video_id = o.video_id
  AND x.step = 'fetch_videos' AND x.status = 'SUCCESS')"""


def _parent_lookup(spark, d):
    from chronoledger.operators.outcomes import parent_lookup, succeeded_entities
    from chronoledger.operators.queue import owned_targets
    ok = succeeded_entities(owned_targets(SI.targets(spark, d), SI.state(spark, d)), SI.outcomes(spark, d))
    return parent_lookup(ok, SI.videos(spark, d))


@register("parent_lookup", PARENT_SQL)
def q_parent_lookup(spark, d):
    return _parent_lookup(spark, d)


@register("parent_outcomes", f"""WITH vc AS ({PARENT_SQL}),
rc AS (SELECT DISTINCT vc.ingestion_id, vc.channel_id FROM vc JOIN nation n ON vc.channel_id = CAST(n.n_nationkey AS VARCHAR)
       WHERE n.n_regionkey <> 0)
SELECT vc.ingestion_id, vc.video_id, 'fetch_channels' AS step,
  CASE WHEN rc.channel_id IS NOT NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  TIMESTAMP '{QUEUE_AS_OF}' AS completed_at,
  CASE WHEN rc.channel_id IS NULL THEN 'Canal do vídeo não foi retornado pela API' END AS error_message
FROM vc LEFT JOIN rc ON vc.ingestion_id = rc.ingestion_id AND vc.channel_id = rc.channel_id""")
def q_parent_outcomes(spark, d):
    from chronoledger.operators.outcomes import parent_outcomes
    from chronoledger.sources.tables import load
    vc = _parent_lookup(spark, d)
    # channels of region 0 stand in for channels the source did not return
    ok = load(spark, d, "nation").where(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").cast("string").alias("channel_id"))
    returned = vc.select("ingestion_id", "channel_id").join(ok, "channel_id", "left_semi")
    return parent_outcomes(vc, returned, QUEUE_AS_OF)


@register("outcomes_pivot", "SELECT * FROM piv")
def q_outcomes_pivot(spark, d):
    from chronoledger.operators.outcomes import outcomes_flat, outcomes_pivot
    return outcomes_flat(outcomes_pivot(SI.outcomes(spark, d)))


@register("finalize_targets", "SELECT * FROM fin")
def q_finalize_targets(spark, d):
    from chronoledger.operators.outcomes import finalize_targets
    from chronoledger.operators.queue import owned_targets
    owned = owned_targets(SI.targets(spark, d), SI.state(spark, d))
    return finalize_targets(owned, SI.outcomes(spark, d))


FINAL_RUNS_SQL = """SELECT ingestion_id, count(*) AS targets, count(*) FILTER (WHERE status <> 'SUCCESS') AS failed,
  CASE WHEN count(*) FILTER (WHERE status <> 'SUCCESS') = 0 THEN 'SUCCESS' ELSE 'PARTIAL_SUCCESS' END AS status
FROM fin GROUP BY ingestion_id"""


def _final(spark, d):
    from chronoledger.operators.outcomes import finalize_targets
    from chronoledger.operators.queue import owned_targets
    owned = owned_targets(SI.targets(spark, d), SI.state(spark, d))
    return owned, finalize_targets(owned, SI.outcomes(spark, d))


@register("finalize_runs", FINAL_RUNS_SQL)
def q_finalize_runs(spark, d):
    from chronoledger.operators.outcomes import finalize_runs
    return finalize_runs(_final(spark, d)[1])


NAMES_SQL = """SELECT r.ingestion_id, n.channel_name FROM (SELECT DISTINCT ingestion_id FROM owned) r LEFT JOIN (
  SELECT o.ingestion_id, string_agg(DISTINCT c.title, ', ' ORDER BY c.title) AS channel_name
  FROM owned o JOIN videos v ON o.video_id = v.video_id JOIN channels c ON v.channel_id = c.channel_id
  WHERE c.title IS NOT NULL GROUP BY o.ingestion_id) n ON r.ingestion_id = n.ingestion_id"""


@register("run_channel_names", NAMES_SQL)
def q_run_channel_names(spark, d):
    from chronoledger.operators.outcomes import run_channel_names
    from chronoledger.operators.queue import owned_targets
    owned = owned_targets(SI.targets(spark, d), SI.state(spark, d))
    return run_channel_names(owned, SI.videos(spark, d), SI.channels(spark, d))


@register("children_by_parent", """SELECT p.ingestion_id, p.video_id, h.comment_id FROM
  (SELECT DISTINCT ingestion_id, video_id FROM outcomes WHERE step = 'fetch_comments' AND status = 'SUCCESS') p
  LEFT JOIN handoff h ON p.ingestion_id = h.ingestion_id AND p.video_id = h.video_id""")
def q_children_by_parent(spark, d):
    from chronoledger.operators.outcomes import children_by_parent
    return children_by_parent(SI.handoff(spark, d), SI.outcomes(spark, d))


@register("merge_finish_target", f"""SELECT s.video_id,
  CASE WHEN f.video_id IS NOT NULL THEN f.status ELSE s.status END AS status,
  CASE WHEN f.video_id IS NOT NULL THEN coalesce(s.first_processed_at, CASE WHEN f.status = 'SUCCESS' THEN TIMESTAMP '{QUEUE_AS_OF}' END)
       ELSE s.first_processed_at END AS first_processed_at,
  CASE WHEN f.video_id IS NOT NULL THEN NULL ELSE s.claimed_at END AS claimed_at,
  s.last_attempt_at,
  CASE WHEN f.video_id IS NOT NULL AND f.status = 'SUCCESS' THEN TIMESTAMP '{QUEUE_AS_OF}' ELSE s.last_succeeded_at END AS last_succeeded_at,
  CASE WHEN f.video_id IS NOT NULL THEN TIMESTAMP '{QUEUE_AS_OF}' + to_hours(CAST(f.refresh_interval_hours AS BIGINT))
       ELSE s.next_refresh_at END AS next_refresh_at,
  s.attempt_count,
  CASE WHEN f.video_id IS NOT NULL THEN f.ingestion_id ELSE s.last_ingestion_id END AS last_ingestion_id,
  CASE WHEN f.video_id IS NOT NULL THEN f.error_message ELSE s.error_message END AS error_message
FROM state s LEFT JOIN fin f ON s.video_id = f.video_id""")
def q_merge_finish_target(spark, d):
    from chronoledger.operators.queue import finish_targets_merge
    _, fin = _final(spark, d)
    return finish_targets_merge(SI.state(spark, d), fin, QUEUE_AS_OF)


@register("merge_finish_run", f"""WITH fr AS ({FINAL_RUNS_SQL}), nm AS ({NAMES_SQL})
SELECT r.ingestion_id, r.channel_handle,
  CASE WHEN fr.ingestion_id IS NOT NULL THEN coalesce(nm.channel_name, r.channel_name) ELSE r.channel_name END AS channel_name,
  r.started_at,
  CASE WHEN fr.ingestion_id IS NOT NULL THEN TIMESTAMP '{QUEUE_AS_OF}' ELSE r.ended_at END AS ended_at,
  CASE WHEN fr.ingestion_id IS NOT NULL THEN fr.status ELSE r.status END AS status,
  CASE WHEN fr.ingestion_id IS NOT NULL THEN NULL ELSE r.error_message END AS error_message
FROM runs r LEFT JOIN fr ON r.ingestion_id = fr.ingestion_id LEFT JOIN nm ON r.ingestion_id = nm.ingestion_id""")
def q_merge_finish_run(spark, d):
    from chronoledger.operators.outcomes import finalize_runs, run_channel_names
    from chronoledger.operators.queue import finish_runs_merge
    owned, fin = _final(spark, d)
    names = run_channel_names(owned, SI.videos(spark, d), SI.channels(spark, d))
    closed = finalize_runs(fin).join(names, "ingestion_id", "left").select(
        "ingestion_id", "status", F.lit(None).cast("string").alias("error_message"), "channel_name")
    return finish_runs_merge(SI.runs(spark, d), closed, QUEUE_AS_OF)


# ---------------------------------------------------------------- merges
from chronoledger.operators import dedupe as D  # noqa: E402
from chronoledger.operators import merge as M  # noqa: E402

T1 = "2024-01-15 00:00:00"
T_NOW = "2024-01-30 00:00:00"


def _upsert_sides(spark, d):
    tgt = SI.current_videos(spark, d, T1, None, "BUILDING", T1)
    src = SI.current_videos(spark, d, None, T1, "MACHINERY", T_NOW)
    return tgt, src


def _cur_sql(cond, skip_segment, at):
    return f"""SELECT video_id, title, view_count, TIMESTAMP '{at}' AS ingested_at FROM (
  SELECT CAST(user_id AS VARCHAR) AS video_id, event_type || ' #' || CAST(event_id AS VARCHAR) AS title,
    CAST(floor(value * 100) AS BIGINT) AS view_count,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE {cond}
    AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> '{skip_segment}')) x WHERE rn = 1"""


UPSERT_SIDES = [("tgt", _cur_sql(f"ts < TIMESTAMP '{T1}'", "BUILDING", T1)),
                ("src", _cur_sql(f"ts >= TIMESTAMP '{T1}'", "MACHINERY", T_NOW))]
UPSERT_SQL = """SELECT coalesce(s.video_id, t.video_id) AS video_id,
  CASE WHEN s.video_id IS NOT NULL THEN s.title ELSE t.title END AS title,
  CASE WHEN s.video_id IS NOT NULL THEN s.view_count ELSE t.view_count END AS view_count,
  CASE WHEN s.video_id IS NOT NULL THEN s.ingested_at ELSE t.ingested_at END AS ingested_at
FROM tgt t FULL OUTER JOIN src s ON t.video_id = s.video_id"""


@register("merge_upsert", UPSERT_SQL, UPSERT_SIDES)
def q_merge_upsert(spark, d):
    tgt, src = _upsert_sides(spark, d)
    return M.upsert(tgt, src, "video_id")


@register("merge_upsert_shuffle", UPSERT_SQL, UPSERT_SIDES)
def q_merge_upsert_shuffle(spark, d):
    """Same merge forced onto the shuffle (full outer join) plan."""
    tgt, src = _upsert_sides(spark, d)
    return M.upsert(tgt, src, "video_id", strategy="shuffle")


INS_SIDES = [("tgt", "SELECT * FROM vsnap WHERE collected_at < TIMESTAMP '2024-01-20 00:00:00'"),
             ("src", """SELECT video_id, ingestion_id, collected_at, view_count + 1 AS view_count, like_count, comment_count
FROM vsnap WHERE collected_at >= TIMESTAMP '2024-01-10 00:00:00'""")]


@register("merge_insert_only", """SELECT * FROM tgt UNION ALL
SELECT s.* FROM src s WHERE NOT EXISTS (SELECT 1 FROM tgt t WHERE t.video_id = s.video_id AND t.ingestion_id = s.ingestion_id)""",
          INS_SIDES)
def q_merge_insert_only(spark, d):
    snaps = SI.video_snapshots(spark, d)
    tgt = snaps.where(F.col("collected_at") < SI.ts("2024-01-20 00:00:00"))
    src = snaps.where(F.col("collected_at") >= SI.ts("2024-01-10 00:00:00")).withColumn(
        "view_count", F.col("view_count") + 1)
    return M.insert_only(tgt, src, ["video_id", "ingestion_id"])


def _dedup_sql(where):
    return f"""SELECT ingestion_id, video_id, step, status, completed_at, error_message FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ingestion_id, video_id, step
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) AS rn
  FROM outcomes_raw WHERE {where}) x WHERE rn = 1"""


@register("merge_composite_key", """SELECT coalesce(t.ingestion_id, s.ingestion_id) AS ingestion_id,
  coalesce(t.video_id, s.video_id) AS video_id, coalesce(t.step, s.step) AS step,
  CASE WHEN s.step IS NOT NULL THEN s.status ELSE t.status END AS status,
  CASE WHEN s.step IS NOT NULL THEN s.completed_at ELSE t.completed_at END AS completed_at,
  CASE WHEN s.step IS NOT NULL THEN s.error_message ELSE t.error_message END AS error_message
FROM tgt t FULL OUTER JOIN src s ON t.ingestion_id = s.ingestion_id AND t.video_id = s.video_id AND t.step = s.step""",
          [("tgt", _dedup_sql("status = 'SUCCESS'")), ("src", _dedup_sql("status <> 'SUCCESS'"))])
def q_merge_composite_key(spark, d):
    raw = SI.outcomes_raw(spark, d)
    keys = ["ingestion_id", "video_id", "step"]
    cols = [f.name for f in S.INGESTION_STEP_OUTCOMES.fields]
    tgt = D.latest_per_key(raw.where(F.col("status") == "SUCCESS"), keys, SI.OUTCOME_ORDER, keep=cols)
    src = D.latest_per_key(raw.where(F.col("status") != "SUCCESS"), keys, SI.OUTCOME_ORDER, keep=cols)
    return M.merge(tgt, src, keys,
                   update={"status": "s.status", "completed_at": "s.completed_at",
                           "error_message": "s.error_message"},
                   insert="*")


@register("merge_source_conflicts", """SELECT ingestion_id, video_id, step, count(*) AS n_rows FROM outcomes_raw
GROUP BY ingestion_id, video_id, step HAVING count(*) > 1""")
def q_merge_source_conflicts(spark, d):
    return M.source_conflicts(SI.outcomes_raw(spark, d), ["ingestion_id", "video_id", "step"])


@register("dedupe_latest", """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) x WHERE rn = 1""")
def q_dedupe_latest(spark, d):
    from chronoledger.sources.tables import load
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey",
                                           "l_suppkey", "l_quantity")
    return D.latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@register("dedupe_composite", "SELECT * FROM outcomes")
def q_dedupe_composite(spark, d):
    return SI.outcomes(spark, d)


# ---------------------------------------------------------------- maintenance
PAUSE_AT = "1995-09-01 00:00:00"
AFTER_SQL = f"""SELECT video_id, CASE WHEN priority = 3 THEN false ELSE is_active END AS is_active, priority,
  refresh_interval_hours, created_at, CASE WHEN priority = 3 THEN TIMESTAMP '{PAUSE_AT}' ELSE updated_at END AS updated_at
FROM targets WHERE refresh_interval_hours <> 168
UNION ALL SELECT * FROM newtargets"""


def _paused(spark, d):
    return M.update_where(SI.targets(spark, d), F.col("priority") == 3,
                          {"is_active": F.lit(False), "updated_at": SI.ts(PAUSE_AT)})


@register("update_where", f"""SELECT video_id, CASE WHEN priority = 3 THEN false ELSE is_active END AS is_active, priority,
  refresh_interval_hours, created_at, CASE WHEN priority = 3 THEN TIMESTAMP '{PAUSE_AT}' ELSE updated_at END AS updated_at
FROM targets""")
def q_update_where(spark, d):
    return _paused(spark, d)


@register("target_register", "SELECT * FROM targets UNION ALL SELECT * FROM newtargets")
def q_target_register(spark, d):
    return SI.targets(spark, d).unionByName(SI.supplier_targets(spark, d, PAUSE_AT))


@register("delete_where", "SELECT * FROM outcomes WHERE (error_message = '') IS NOT TRUE")
def q_delete_where(spark, d):
    # rows whose predicate is NULL (no error message) are kept
    return M.delete_where(SI.outcomes(spark, d), F.col("error_message") == "")


_CF_COLS = ["is_active", "priority", "refresh_interval_hours", "created_at", "updated_at"]
_CF_DIFF = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in _CF_COLS)


@register("change_feed", f"""SELECT a.*, 'insert' AS _change_type FROM aft a WHERE a.video_id NOT IN (SELECT video_id FROM targets)
UNION ALL SELECT b.*, 'delete' FROM targets b WHERE b.video_id NOT IN (SELECT video_id FROM aft)
UNION ALL SELECT b.*, 'update_preimage' FROM targets b JOIN aft a ON b.video_id = a.video_id WHERE {_CF_DIFF}
UNION ALL SELECT a.*, 'update_postimage' FROM targets b JOIN aft a ON b.video_id = a.video_id WHERE {_CF_DIFF}""",
          [("aft", AFTER_SQL)])
def q_change_feed(spark, d):
    before = SI.targets(spark, d)
    after = M.delete_where(_paused(spark, d), F.col("refresh_interval_hours") == 168).unionByName(
        SI.supplier_targets(spark, d, PAUSE_AT))
    return M.change_feed(before, after, "video_id")


NEW_HANDOFF_SQL = """SELECT CAST(conv_id % 3 AS VARCHAR) AS ingestion_id,
  CASE WHEN turn = 7 THEN '' ELSE CAST(conv_id AS VARCHAR) END AS video_id,
  CAST(conv_id AS VARCHAR) || '-' || CAST(turn % 4 AS VARCHAR) AS comment_id FROM conversations"""


@register("replace_slice", """SELECT * FROM handoff WHERE ingestion_id NOT IN (SELECT ingestion_id FROM nh)
UNION ALL SELECT DISTINCT ingestion_id, video_id, comment_id FROM nh
  WHERE video_id IS NOT NULL AND video_id <> '' AND comment_id IS NOT NULL AND comment_id <> ''""",
          [("nh", NEW_HANDOFF_SQL)])
def q_replace_slice(spark, d):
    from chronoledger.sources.tables import load
    c = load(spark, d, "conversations")
    new = c.select((F.col("conv_id") % 3).cast("string").alias("ingestion_id"),
                   F.when(F.col("turn") == 7, F.lit("")).otherwise(F.col("conv_id").cast("string")).alias("video_id"),
                   F.concat(F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") % 4).cast("string"))
                   .alias("comment_id"))
    return M.replace_slice(SI.handoff(spark, d), "ingestion_id", new, new,
                           required=["video_id", "comment_id"], dedupe_keys=["ingestion_id", "comment_id"])


@register("run_open", """SELECT * FROM runs UNION ALL
SELECT DISTINCT 'run-' || strftime(o_orderdate, '%Y%m%d') AS ingestion_id, 'control.video_targets' AS channel_handle,
  CAST(NULL AS VARCHAR) AS channel_name, o_orderdate AS started_at, CAST(NULL AS TIMESTAMP) AS ended_at,
  'RUNNING' AS status, CAST(NULL AS VARCHAR) AS error_message FROM orders""")
def q_run_open(spark, d):
    from chronoledger.operators.queue import open_runs
    from chronoledger.sources.tables import load
    days = load(spark, d, "orders").select("o_orderdate").distinct().select(
        F.concat(F.lit("run-"), F.date_format("o_orderdate", "yyyyMMdd")).alias("ingestion_id"),
        F.col("o_orderdate").alias("started_at"))
    return SI.runs(spark, d).unionByName(open_runs(spark, days))


@register("schema_add_column", "SELECT * EXCLUDE (channel_name), CAST(NULL AS VARCHAR) AS channel_name FROM runs")
def q_schema_add_column(spark, d):
    from chronoledger.sources.tables import add_column
    return add_column(SI.runs(spark, d).drop("channel_name"), "channel_name", "string")


REQ = ["video_id", "ingestion_id", "collected_at"]


@register("not_null_violations", """SELECT *, concat_ws(',', CASE WHEN video_id IS NULL THEN 'video_id' END,
  CASE WHEN ingestion_id IS NULL THEN 'ingestion_id' END, CASE WHEN collected_at IS NULL THEN 'collected_at' END) AS violated
FROM cand WHERE video_id IS NULL OR ingestion_id IS NULL OR collected_at IS NULL""")
def q_not_null_violations(spark, d):
    from chronoledger.sources.tables import not_null_violations
    return not_null_violations(SI.candidate_snapshots(spark, d), REQ)


@register("drop_blank_keys", """SELECT * FROM cand WHERE video_id IS NOT NULL AND video_id <> ''
  AND ingestion_id IS NOT NULL AND ingestion_id <> ''""")
def q_drop_blank_keys(spark, d):
    return D.drop_blank_keys(SI.candidate_snapshots(spark, d), ["video_id", "ingestion_id"])


@register("snapshot_project", f"""SELECT video_id, 'snap-run' AS ingestion_id, TIMESTAMP '{PAUSE_AT}' AS collected_at,
  view_count, like_count, comment_count FROM videos WHERE video_id IS NOT NULL AND video_id <> ''""")
def q_snapshot_project(spark, d):
    from chronoledger.operators.snapshots import snapshot_rows
    return snapshot_rows(SI.videos(spark, d), "videos", "snap-run", PAUSE_AT)


# ---------------------------------------------------------------- inspection
@register("outcomes_recent", "SELECT * FROM outcomes")
def q_outcomes_recent(spark, d):
    return SI.outcomes(spark, d).orderBy(F.col("completed_at").desc(), "ingestion_id", "video_id", "step")


@register("handoff_sorted", "SELECT * FROM handoff")
def q_handoff_sorted(spark, d):
    return SI.handoff(spark, d).orderBy("ingestion_id", "video_id", "comment_id")


@register("comments_sample", "SELECT comment_id, video_id, author_name, text FROM comments ORDER BY comment_id LIMIT 5")
def q_comments_sample(spark, d):
    return SI.comments(spark, d).select("comment_id", "video_id", "author_name", "text").orderBy(
        "comment_id").limit(5)


def _inspect(name: str, table: str, columns: list[str] | None = None, order: list[str] | None = None, limit: int | None = None):
    """A look at one stored table: all rows, some columns, or a first few."""
    def run(spark, d):
        df = getattr(SI, table)(spark, d)
        df = df.select(*columns) if columns else df
        df = df.orderBy(*order) if order else df
        return df.limit(limit) if limit else df
    text = f"SELECT {', '.join(columns) if columns else '*'} FROM {_CTE_OF.get(table, table)}"
    text += f" ORDER BY {', '.join(order)}" if order else ""
    register(name, text + (f" LIMIT {limit}" if limit else ""))(run)


_CTE_OF = {"video_snapshots": "vsnap", "channel_snapshots": "csnap"}
_COUNTS = ["view_count", "like_count", "comment_count"]
_inspect("inspect_targets", "targets")
_inspect("inspect_state", "state")
_inspect("inspect_runs", "runs")
_inspect("inspect_channels", "channels", ["channel_id", "title", "view_count", "subscriber_count", "video_count", "ingested_at"])
_inspect("inspect_videos", "videos", ["video_id", "channel_id", "title", "published_at", *_COUNTS, "ingested_at"])
_inspect("inspect_replies", "replies", ["video_id", "comment_id", "parent_id", "author_name", "text", "like_count", "published_at",
                                        "updated_at", "ingested_at"], ["comment_id"], 5)
_inspect("inspect_channel_snapshots", "channel_snapshots")
_inspect("inspect_video_snapshots", "video_snapshots")


@register("handle_normalize", """SELECT h AS handle, CASE WHEN starts_with(h, '@') THEN substr(h, 2) ELSE h END AS handle_normalized
FROM (SELECT CASE c_custkey % 3 WHEN 0 THEN '@@' WHEN 1 THEN '@' ELSE '' END || lower(replace(c_name, '#', '_')) AS h
      FROM customer) x""")
def q_handle_normalize(spark, d):
    from chronoledger.functions.columns import strip_handle
    from chronoledger.sources.tables import load
    c = load(spark, d, "customer")
    h = F.concat(F.when(F.col("c_custkey") % 3 == 0, "@@").when(F.col("c_custkey") % 3 == 1, "@").otherwise(""),
                 F.lower(F.regexp_replace("c_name", "#", "_")))
    return c.select(h.alias("handle")).select("handle", strip_handle("handle").alias("handle_normalized"))


@register("bounded_children", """SELECT parent_id, comment_id, rn AS rank FROM (
  SELECT parent_id, comment_id, ROW_NUMBER() OVER (PARTITION BY parent_id ORDER BY comment_id DESC) AS rn FROM replies) x
WHERE rn <= 5""")
def q_bounded_children(spark, d):
    from chronoledger.operators.topn import bounded_per_group
    return bounded_per_group(SI.replies(spark, d).select("parent_id", "comment_id"), "parent_id",
                             [F.col("comment_id").desc()], 5, rank_col="rank")


# ---------------------------------------------------------------- raw JSON
from chronoledger.operators import normalize as N  # noqa: E402
from chronoledger.sources import rawpages as RP  # noqa: E402


def _pos(order, page):
    return f"CAST(ROW_NUMBER() OVER (PARTITION BY {page} ORDER BY {order}) - 1 AS INTEGER)"


@register("normalize_videos", f"""SELECT 'run-' || CAST(event_id // 500 AS VARCHAR) AS ingestion_id,
  max(ts) OVER (PARTITION BY event_id // 50) AS received_at, CAST(event_id // 50 AS BIGINT) AS page_no, {_pos('event_id', 'event_id // 50')} AS item_pos,
  CAST(event_id AS VARCHAR) AS video_id, CAST(user_id % 25 AS VARCHAR) AS channel_id,
  'NATION_' || CAST(user_id % 25 AS VARCHAR) AS channel_title, event_type || ' #' || CAST(event_id AS VARCHAR) AS title,
  props AS description, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at, CAST(user_id % 10 AS VARCHAR) AS category_id,
  CASE WHEN event_id % 3 = 2 THEN event_type || '|u' || CAST(user_id AS VARCHAR) ELSE '' END AS tags_text,
  CASE WHEN event_id % 3 = 2 THEN 2 ELSE 0 END AS n_tags,
  'PT' || CAST(event_id % 600 AS VARCHAR) || 'S' AS duration, CASE WHEN event_id % 2 = 0 THEN 'hd' ELSE 'sd' END AS definition,
  'false' AS caption,
  CASE WHEN event_id % 13 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS view_count,
  CASE WHEN event_id % 13 = 0 OR event_id % 7 = 0 THEN NULL ELSE CAST(floor(value * 10) AS BIGINT) END AS like_count,
  CASE WHEN event_id % 13 = 0 OR event_type = 'error' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS comment_count,
  'public' AS privacy_status
FROM events""")
def q_normalize_videos(spark, d):
    v = N.normalize_videos(RP.video_pages(spark, d))
    return v.select(*[c for c in v.columns if c != "tags"],
                    F.array_join("tags", "|").alias("tags_text"), F.size("tags").alias("n_tags"))


@register("normalize_channels", f"""SELECT 'run-' || CAST(c_custkey // 500 AS VARCHAR) AS ingestion_id,
  TIMESTAMP '2024-02-01 00:00:00' AS received_at, CAST(c_custkey // 50 AS BIGINT) AS page_no, {_pos('c_custkey', 'c_custkey // 50')} AS item_pos,
  'UC' || CAST(c_custkey AS VARCHAR) AS channel_id, c_name AS title, c_mktsegment AS description,
  '@c' || CAST(c_custkey AS VARCHAR) AS custom_url, CAST(NULL AS VARCHAR) AS published_at,
  CAST(c_nationkey AS VARCHAR) AS country, CAST(floor(c_acctbal) AS BIGINT) AS view_count,
  CASE WHEN c_custkey % 4 <> 0 THEN c_custkey * 10 END AS subscriber_count,
  CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 97 ELSE 0 END AS video_count,
  CASE WHEN c_custkey % 6 <> 0 THEN 'UU' || CAST(c_custkey AS VARCHAR) END AS uploads_playlist_id
FROM customer""")
def q_normalize_channels(spark, d):
    return N.normalize_channels(RP.channel_pages(spark, d))


_AUTHOR = "CASE WHEN conv_id % 4 <> 0 THEN 'UC' || role END"
_LIKES = "CASE WHEN conv_id % 5 <> 0 THEN CAST(length(text) % 50 AS BIGINT) ELSE 0 END"
_PUB = "'2024-01-' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z'"


@register("normalize_comments", f"""SELECT 'run-' || CAST(conv_id // 500 AS VARCHAR) AS ingestion_id,
  TIMESTAMP '2024-02-01 00:00:00' AS received_at, CAST(conv_id // 50 AS BIGINT) AS page_no, {_pos('conv_id', 'conv_id // 50')} AS item_pos,
  't' || CAST(conv_id AS VARCHAR) AS thread_id, CAST(conv_id AS VARCHAR) || '-0' AS comment_id,
  CAST(NULL AS VARCHAR) AS parent_id, CAST(conv_id AS VARCHAR) AS video_id, role AS author_name,
  {_AUTHOR} AS author_channel_id, text, {_LIKES} AS like_count, {_PUB} AS published_at,
  CAST(NULL AS VARCHAR) AS updated_at,
  CASE WHEN conv_id % 3 <> 0 THEN (SELECT count(*) - 1 FROM conversations c2 WHERE c2.conv_id = c.conv_id) ELSE 0 END AS reply_count
FROM conversations c WHERE turn = 0""")
def q_normalize_comments(spark, d):
    return N.normalize_comments(RP.thread_pages(spark, d))


@register("normalize_replies", f"""SELECT 'run-' || CAST((conv_id * 8 + turn) // 500 AS VARCHAR) AS ingestion_id,
  TIMESTAMP '2024-02-01 00:00:00' AS received_at,
  CAST((conv_id * 8 + turn) // 50 AS BIGINT) AS page_no, {_pos('conv_id * 8 + turn', '(conv_id * 8 + turn) // 50')} AS item_pos,
  CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id, CAST(conv_id AS VARCHAR) || '-0' AS parent_id,
  CAST(conv_id AS VARCHAR) AS video_id, role AS author_name, {_AUTHOR} AS author_channel_id, text,
  {_LIKES} AS like_count, {_PUB} AS published_at, CAST(NULL AS VARCHAR) AS updated_at
FROM conversations WHERE turn > 0""")
def q_normalize_replies(spark, d):
    return N.normalize_replies(RP.reply_pages(spark, d))


@register("normalize_playlist_items", f"""SELECT 'run-' || CAST(o_orderkey // 500 AS VARCHAR) AS ingestion_id,
  max(o_orderdate) OVER (PARTITION BY o_orderkey // 50) AS received_at,
  CAST(o_orderkey // 50 AS BIGINT) AS page_no, {_pos('o_orderkey', 'o_orderkey // 50')} AS item_pos,
  CAST(o_custkey AS VARCHAR) AS video_id, 'order ' || CAST(o_orderkey AS VARCHAR) AS title,
  o_orderpriority AS description, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
  CAST(o_orderkey % 50 AS BIGINT) AS playlist_position
FROM orders""")
def q_normalize_playlist_items(spark, d):
    return N.normalize_playlist_items(RP.playlist_pages(spark, d))


FLAT_SQL = f"""SELECT 'run-' || CAST(event_id // 500 AS VARCHAR) AS ingestion_id, 'videos' AS resource,
  max(ts) OVER (PARTITION BY event_id // 50) AS received_at, CAST(event_id // 50 AS BIGINT) AS page_no, {_pos('event_id', 'event_id // 50')} AS item_pos FROM events
UNION ALL SELECT 'run-' || CAST(c_custkey // 500 AS VARCHAR), 'channels', TIMESTAMP '2024-02-01 00:00:00', c_custkey // 50,
  {_pos('c_custkey', 'c_custkey // 50')} FROM customer
UNION ALL SELECT 'run-' || CAST(conv_id // 500 AS VARCHAR), 'commentThreads', TIMESTAMP '2024-02-01 00:00:00', conv_id // 50,
  {_pos('conv_id', 'conv_id // 50')} FROM conversations WHERE turn = 0
UNION ALL SELECT 'run-' || CAST((conv_id * 8 + turn) // 500 AS VARCHAR), 'comments', TIMESTAMP '2024-02-01 00:00:00', (conv_id * 8 + turn) // 50,
  {_pos('conv_id * 8 + turn', '(conv_id * 8 + turn) // 50')} FROM conversations WHERE turn > 0
UNION ALL SELECT 'run-' || CAST(o_orderkey // 500 AS VARCHAR), 'playlistItems',
  max(o_orderdate) OVER (PARTITION BY o_orderkey // 50), o_orderkey // 50, {_pos('o_orderkey', 'o_orderkey // 50')} FROM orders"""


def _all_pages(spark, d):
    return (RP.video_pages(spark, d).unionByName(RP.channel_pages(spark, d))
            .unionByName(RP.thread_pages(spark, d)).unionByName(RP.reply_pages(spark, d))
            .unionByName(RP.playlist_pages(spark, d)))


@register("raw_flatten", FLAT_SQL)
def q_raw_flatten(spark, d):
    return N.raw_flatten(_all_pages(spark, d)).drop("item_json")


PACK_SQL = """SELECT 'run-' || CAST(event_id // 50 // 10 AS VARCHAR) AS ingestion_id, 'videos' AS resource,
  '{"id":"' || string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY CAST(event_id AS VARCHAR))
    || '","maxResults":"50","part":"snippet,contentDetails,statistics,status"}' AS request_params_json,
  max(ts) AS received_at, count(*) AS n_items
FROM events GROUP BY event_id // 50"""


@register("raw_pack", PACK_SQL)
def q_raw_pack(spark, d):
    p = RP.video_pages(spark, d)
    return p.select("ingestion_id", "resource", "request_params_json", "received_at",
                    F.size(F.from_json("response_json", N.PAGE_SCHEMA)["items"]).cast("bigint").alias("n_items"))


@register("inspect_raw", PACK_SQL)
def q_inspect_raw(spark, d):
    """The stored pages with their request, and how many items each holds."""
    return q_raw_pack(spark, d)


@register("raw_append", """SELECT ingestion_id, resource, received_at, n_items FROM (""" + PACK_SQL + """) v
UNION ALL SELECT 'run-' || CAST(c_custkey // 500 AS VARCHAR), 'channels', TIMESTAMP '2024-02-01 00:00:00', count(*)
FROM customer GROUP BY c_custkey // 50, c_custkey // 500""")
def q_raw_append(spark, d):
    from chronoledger import schemas as S
    from chronoledger.sources.tables import conform
    raw = conform(RP.video_pages(spark, d), S.API_RESPONSES)
    raw = raw.unionByName(conform(RP.channel_pages(spark, d), S.API_RESPONSES))
    return raw.select("ingestion_id", "resource", "received_at",
                      F.size(F.from_json("response_json", N.PAGE_SCHEMA)["items"]).cast("bigint").alias("n_items"))


@register("classify_errors", "SELECT attempt_id, video_id, status_code, category, retryable, message FROM classified")
def q_classify_errors(spark, d):
    from chronoledger.functions.errors import with_error_class
    f = with_error_class(SI.request_failures(spark, d), "status_code", "body")
    return f.select("attempt_id", "video_id", "status_code", "category", "retryable", "message")


@register("comment_outcomes", """SELECT v.video_id, CASE WHEN f.category IS NULL OR f.category = 'COMMENTS_DISABLED' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CASE WHEN f.category IS NOT NULL AND f.category <> 'COMMENTS_DISABLED' THEN f.message END AS error_message, f.category
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS video_id FROM events) v LEFT JOIN (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY video_id ORDER BY ts, attempt_id) AS rn
                 FROM classified WHERE event_type = 'error') x WHERE rn = 1) f ON v.video_id = f.video_id""")
def q_comment_outcomes(spark, d):
    from chronoledger.operators.outcomes import comment_outcomes
    from chronoledger.sources.tables import load
    videos = load(spark, d, "events").select(F.col("user_id").cast("string").alias("video_id")).distinct()
    fails = SI.request_failures(spark, d).where(F.col("event_type") == "error")
    return comment_outcomes(videos, fails).drop("message")


# ---------------------------------------------------------------- run steps
from chronoledger.plans import ingest as IG  # noqa: E402


def _upsert_sql(target: str, new: str, key: str, cols: list[str], tgt_expr: dict | None = None) -> str:
    tgt_expr = tgt_expr or {}
    sel = [f"coalesce(n.{key}, t.{key}) AS {key}"]
    for c in cols:
        if c == key:
            continue
        te = tgt_expr.get(c, f"t.{c}")
        sel.append(f"CASE WHEN n.{key} IS NOT NULL THEN n.{c} ELSE {te} END AS {c}")
    return f"SELECT {', '.join(sel)} FROM {target} t FULL OUTER JOIN {new} n ON t.{key} = n.{key}"


_VID_COLS = ["video_id", "channel_id", "channel_title", "title", "description", "published_at", "category_id",
             "tags_text", "duration", "definition", "caption", "view_count", "like_count", "comment_count",
             "privacy_status", "ingested_at"]
NEW_VIDEOS_SQL = f"""SELECT CAST(c.c_custkey AS VARCHAR) AS video_id, CAST(c.c_nationkey AS VARCHAR) AS channel_id,
  'NATION_' || CAST(c.c_nationkey AS VARCHAR) AS channel_title, c.c_name || ' (refreshed)' AS title,
  c.c_mktsegment AS description, CAST(NULL AS VARCHAR) AS published_at, CAST(c.c_custkey % 30 AS VARCHAR) AS category_id,
  c.c_mktsegment AS tags_text, 'PT1M' AS duration, 'hd' AS definition, 'false' AS caption,
  CAST(floor(c.c_acctbal * 10) AS BIGINT) AS view_count, CAST(c.c_custkey % 100 AS BIGINT) AS like_count,
  CASE WHEN c.c_custkey % 3 <> 0 THEN CAST(c.c_custkey % 1000 AS BIGINT) END AS comment_count,
  'public' AS privacy_status, TIMESTAMP '{QUEUE_AS_OF}' AS ingested_at
FROM owned o JOIN customer c ON o.video_id = CAST(c.c_custkey AS VARCHAR) WHERE c.c_acctbal >= 0"""


def _std_tables(spark, d):
    return SI.tables(spark, d)


@register("apply_videos", _upsert_sql("videos", "nv", "video_id", _VID_COLS,
                                      {"tags_text": "array_to_string(t.tags, '|')"}),
          [("nv", NEW_VIDEOS_SQL)])
def q_apply_videos(spark, d):
    from chronoledger.operators.queue import owned_targets
    t = _std_tables(spark, d)
    owned = owned_targets(t["video_targets"], t["video_processing_state"])
    raw = RP.owned_video_pages(spark, d, owned, QUEUE_AS_OF)
    out, _ = IG.apply_videos(t, raw, QUEUE_AS_OF, owned)
    v = out["videos"]
    return v.select(*[c if c != "tags" else F.array_join("tags", "|").alias("tags_text") for c in v.columns])


@register("apply_video_snapshots", f"""SELECT * FROM vsnap UNION ALL
SELECT CAST(c.c_custkey AS VARCHAR) AS video_id, o.ingestion_id, TIMESTAMP '{QUEUE_AS_OF}' AS collected_at,
  CAST(floor(c.c_acctbal * 10) AS BIGINT) AS view_count, CAST(c.c_custkey % 100 AS BIGINT) AS like_count,
  CASE WHEN c.c_custkey % 3 <> 0 THEN CAST(c.c_custkey % 1000 AS BIGINT) END AS comment_count
FROM owned o JOIN customer c ON o.video_id = CAST(c.c_custkey AS VARCHAR) WHERE c.c_acctbal >= 0""")
def q_apply_video_snapshots(spark, d):
    from chronoledger.operators.queue import owned_targets
    t = _std_tables(spark, d)
    owned = owned_targets(t["video_targets"], t["video_processing_state"])
    out, _ = IG.apply_videos(t, RP.owned_video_pages(spark, d, owned, QUEUE_AS_OF), QUEUE_AS_OF, owned)
    return out["video_snapshots"]


_CH_COLS = ["channel_id", "title", "description", "custom_url", "published_at", "country", "view_count",
            "subscriber_count", "video_count", "uploads_playlist_id", "ingested_at"]
NEW_CHANNELS_SQL = f"""SELECT DISTINCT CAST(n.n_nationkey AS VARCHAR) AS channel_id, n.n_name || ' channel' AS title,
  'region ' || CAST(n.n_regionkey AS VARCHAR) AS description, '@' || lower(n.n_name) AS custom_url,
  CAST(NULL AS VARCHAR) AS published_at, CAST(n.n_regionkey AS VARCHAR) AS country,
  CAST(n.n_nationkey * 1000 AS BIGINT) AS view_count,
  CASE WHEN n.n_nationkey % 2 = 0 THEN CAST(n.n_nationkey * 100 AS BIGINT) END AS subscriber_count,
  CAST(n.n_nationkey AS BIGINT) AS video_count, 'UU' || CAST(n.n_nationkey AS VARCHAR) AS uploads_playlist_id,
  TIMESTAMP '{QUEUE_AS_OF}' AS ingested_at
FROM vc JOIN nation n ON vc.channel_id = CAST(n.n_nationkey AS VARCHAR) WHERE n.n_regionkey <> 0"""


@register("apply_channels", _upsert_sql("channels", "nc", "channel_id", _CH_COLS),
          [("vc", PARENT_SQL), ("nc", NEW_CHANNELS_SQL)])
def q_apply_channels(spark, d):
    from chronoledger.operators.outcomes import parent_lookup, succeeded_entities
    from chronoledger.operators.queue import owned_targets
    t = _std_tables(spark, d)
    owned = owned_targets(t["video_targets"], t["video_processing_state"])
    vc = parent_lookup(succeeded_entities(owned, t["ingestion_step_outcomes"]), t["videos"])
    raw = RP.run_channel_pages(spark, d, vc, QUEUE_AS_OF)
    out, _ = IG.apply_channels(t, raw, QUEUE_AS_OF, owned)
    return out["channels"]


_CM_COLS = ["thread_id", "comment_id", "parent_id", "video_id", "author_name", "author_channel_id", "text",
            "like_count", "published_at", "updated_at", "reply_count", "ingested_at"]
CONV_RUNS_SQL = """SELECT conv_id, turn, role, text, CAST(o_orderkey AS VARCHAR) AS ingestion_id,
  CAST(o_custkey AS VARCHAR) AS video FROM conversations JOIN orders ON conv_id = o_orderkey"""
OK_PAIRS_SQL = """SELECT DISTINCT ingestion_id, video_id FROM outcomes WHERE step = 'fetch_videos' AND status = 'SUCCESS'"""
NEW_COMMENTS_SQL = f"""SELECT 't' || CAST(r.conv_id AS VARCHAR) AS thread_id, CAST(r.conv_id AS VARCHAR) || '-0' AS comment_id,
  CAST(NULL AS VARCHAR) AS parent_id, r.video AS video_id, r.role AS author_name, 'UC' || r.role AS author_channel_id,
  r.text, CAST(length(r.text) % 50 AS BIGINT) AS like_count, CAST(NULL AS VARCHAR) AS published_at,
  CAST(NULL AS VARCHAR) AS updated_at,
  (SELECT count(*) - 1 FROM cr c2 WHERE c2.conv_id = r.conv_id) AS reply_count, TIMESTAMP '{QUEUE_AS_OF}' AS ingested_at
FROM cr r JOIN okp ON r.ingestion_id = okp.ingestion_id AND r.video = okp.video_id WHERE r.turn = 0"""


def _all_pairs(t):
    return t["ingestion_step_outcomes"].select("ingestion_id", "video_id").distinct()


@register("apply_comments", _upsert_sql("comments", "ncm", "comment_id", _CM_COLS),
          [("cr", CONV_RUNS_SQL), ("okp", OK_PAIRS_SQL), ("ncm", NEW_COMMENTS_SQL)])
def q_apply_comments(spark, d):
    t = _std_tables(spark, d)
    raw = RP.run_thread_pages(spark, d, QUEUE_AS_OF)
    out, _ = IG.apply_comments(t, raw, QUEUE_AS_OF, _all_pairs(t), max_comments_per_video=20)
    return out["comments"]


@register("apply_comments_handoff", """SELECT * FROM handoff WHERE ingestion_id NOT IN (SELECT ingestion_id FROM okp)
UNION ALL SELECT r.ingestion_id, r.video AS video_id, CAST(r.conv_id AS VARCHAR) || '-0' AS comment_id
FROM cr r JOIN okp ON r.ingestion_id = okp.ingestion_id AND r.video = okp.video_id WHERE r.turn = 0""",
          [("cr", CONV_RUNS_SQL), ("okp", OK_PAIRS_SQL)])
def q_apply_comments_handoff(spark, d):
    t = _std_tables(spark, d)
    raw = RP.run_thread_pages(spark, d, QUEUE_AS_OF)
    out, _ = IG.apply_comments(t, raw, QUEUE_AS_OF, _all_pairs(t), max_comments_per_video=20)
    return out["ingestion_comments"]


_RP_COLS = ["comment_id", "parent_id", "video_id", "author_name", "author_channel_id", "text", "like_count",
            "published_at", "updated_at", "ingested_at"]
NEW_REPLIES_SQL = f"""SELECT CAST(r.conv_id AS VARCHAR) || '-' || CAST(r.turn AS VARCHAR) AS comment_id,
  CAST(r.conv_id AS VARCHAR) || '-0' AS parent_id, r.video AS video_id, r.role AS author_name,
  'UC' || r.role AS author_channel_id, r.text, CAST(r.turn AS BIGINT) AS like_count,
  CAST(NULL AS VARCHAR) AS published_at, CAST(NULL AS VARCHAR) AS updated_at, TIMESTAMP '{QUEUE_AS_OF}' AS ingested_at
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ingestion_id, conv_id ORDER BY turn) AS rn FROM cr WHERE turn > 0) r
WHERE r.rn <= 5
  AND EXISTS (SELECT 1 FROM outcomes x WHERE x.ingestion_id = r.ingestion_id AND x.video_id = r.video
              AND x.step = 'fetch_comments' AND x.status = 'SUCCESS')
  AND EXISTS (SELECT 1 FROM handoff h WHERE h.ingestion_id = r.ingestion_id AND h.video_id = r.video
              AND h.comment_id = CAST(r.conv_id AS VARCHAR) || '-0')"""


@register("apply_replies", _upsert_sql("replies", "nr", "comment_id", _RP_COLS),
          [("cr", CONV_RUNS_SQL), ("nr", NEW_REPLIES_SQL)])
def q_apply_replies(spark, d):
    t = _std_tables(spark, d)
    raw = RP.run_reply_pages(spark, d, QUEUE_AS_OF)
    out, _ = IG.apply_replies(t, raw, QUEUE_AS_OF, _all_pairs(t), max_replies_per_comment=5)
    return out["replies"]


@register("apply_replies_repeated", _upsert_sql("replies", "nr", "comment_id", _RP_COLS),
          [("cr", CONV_RUNS_SQL), ("nr", NEW_REPLIES_SQL)])
def q_apply_replies_repeated(spark, d):
    """Every page was stored by an earlier attempt too: the cap counts children, not copies."""
    t = _std_tables(spark, d)
    raw = RP.run_reply_pages(spark, d, "1995-01-01 00:00:00").unionByName(RP.run_reply_pages(spark, d, QUEUE_AS_OF))
    out, _ = IG.apply_replies(t, raw, QUEUE_AS_OF, _all_pairs(t), max_replies_per_comment=5)
    return out["replies"]


CAP = 3
CAPPED_SQL = f"""SELECT * FROM handoff WHERE ingestion_id NOT IN (SELECT ingestion_id FROM okp)
UNION ALL SELECT r.ingestion_id, r.video AS video_id, CAST(r.conv_id AS VARCHAR) || '-' || CAST(r.turn AS VARCHAR) AS comment_id
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ingestion_id, video ORDER BY turn) AS rn FROM cr) r
JOIN okp ON r.ingestion_id = okp.ingestion_id AND r.video = okp.video_id WHERE r.rn <= {CAP}"""


@register("apply_comments_capped", CAPPED_SQL, [("cr", CONV_RUNS_SQL), ("okp", OK_PAIRS_SQL)])
def q_apply_comments_capped(spark, d):
    """Each turn is a thread, two to a page, and an earlier attempt stored the
    first page of each run: the cap binds across pages and repeats."""
    t = _std_tables(spark, d)
    raw = RP.run_turn_pages(spark, d, QUEUE_AS_OF, 2)
    early = RP.run_turn_pages(spark, d, "1995-01-01 00:00:00", 2).where("page_no = 0")
    out, _ = IG.apply_comments(t, raw.unionByName(early), QUEUE_AS_OF, _all_pairs(t), max_comments_per_video=CAP)
    return out["ingestion_comments"]


FIRST_FAILURE_SQL = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY video_id ORDER BY ts, attempt_id) AS rn
  FROM classified WHERE event_type = 'error') x WHERE rn = 1"""
_OUT = [f.name for f in S.INGESTION_STEP_OUTCOMES.fields]


def _failed_step_sql(step: str, pairs: str, disabled: str) -> str:
    ok = "f.category IS NULL" + (" OR f.category = 'COMMENTS_DISABLED'" if disabled == "ok" else "")
    return f"""SELECT p.ingestion_id, p.video_id, '{step}' AS step, CASE WHEN {ok} THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  TIMESTAMP '{QUEUE_AS_OF}' AS completed_at, CASE WHEN NOT ({ok}) THEN f.message END AS error_message
FROM ({pairs}) p LEFT JOIN ff f ON p.video_id = f.video_id"""


def _failures(spark, d, t):
    fails = SI.request_failures(spark, d).where(F.col("event_type") == "error")
    return fails.join(_all_pairs(t), "video_id").select("ingestion_id", "video_id", "ts", "attempt_id", "status_code", "body")


def _outcomes_of(t, out, before: str, step: str):
    """Outcomes of ``step`` for the pairs whose step ``before`` succeeded."""
    ok = t["ingestion_step_outcomes"].where((F.col("step") == before) & (F.col("status") == S.ST_SUCCESS))
    return out["ingestion_step_outcomes"].where(F.col("step") == step).join(
        ok.select("ingestion_id", "video_id"), ["ingestion_id", "video_id"], "left_semi").select(*_OUT)


@register("apply_comments_failures", _failed_step_sql("fetch_comments", "SELECT * FROM okp", "ok"),
          [("okp", OK_PAIRS_SQL), ("ff", FIRST_FAILURE_SQL)])
def q_apply_comments_failures(spark, d):
    t = _std_tables(spark, d)
    out, _ = IG.apply_comments(t, RP.run_thread_pages(spark, d, QUEUE_AS_OF), QUEUE_AS_OF, _all_pairs(t), 20, _failures(spark, d, t))
    return _outcomes_of(t, out, "fetch_videos", "fetch_comments")


OK_COMMENTS_SQL = """SELECT DISTINCT ingestion_id, video_id FROM outcomes WHERE step = 'fetch_comments' AND status = 'SUCCESS'"""


@register("apply_replies_failures", _failed_step_sql("fetch_replies", OK_COMMENTS_SQL, "failed"), [("ff", FIRST_FAILURE_SQL)])
def q_apply_replies_failures(spark, d):
    t = _std_tables(spark, d)
    out, _ = IG.apply_replies(t, RP.run_reply_pages(spark, d, QUEUE_AS_OF), QUEUE_AS_OF, _all_pairs(t), 5, _failures(spark, d, t))
    return _outcomes_of(t, out, "fetch_comments", "fetch_replies")


@register("step_counts", """SELECT ingestion_id, CASE resource WHEN 'videos' THEN 'fetch_videos'
  WHEN 'channels' THEN 'fetch_channels' WHEN 'commentThreads' THEN 'fetch_comments' WHEN 'comments' THEN 'fetch_replies'
  ELSE 'list_uploads' END AS step, count(*) AS n_rows
FROM (""" + FLAT_SQL + """) f GROUP BY ingestion_id, resource""")
def q_step_counts(spark, d):
    return IG.returned_counts(_all_pages(spark, d))
