"""Stand-ins: the metric-history tables derived from the driver's test data.

The engine's tables (targets, processing state, runs, snapshots, outcomes,
hand-off, raw API pages) are not in the test data, so each is *derived* by a
Spark job from the TPC-H-like tables; the work therefore grows with the
input. Every derivation here has a twin in ``plans.oracle`` written in plain
SQL, so both engines start from identical tables.

| engine table                | derived from                                        |
|-----------------------------|-----------------------------------------------------|
| control.video_targets       | customer                                            |
| control.video_processing_state | orders before 1996, latest order per customer    |
| control.ingestion_runs      | orders                                              |
| control.ingestion_step_outcomes | lineitem x orders (4 steps by line number)      |
| control.ingestion_comments  | conversations                                       |
| silver.video_snapshots      | events (entity = user)                              |
| silver.channel_snapshots    | events (entity = user mod 25)                       |
| silver.videos / channels    | customer / nation                                   |
| silver.comments / replies   | conversations turn 0 / turns > 0                    |
| raw.api_responses           | events packed as 50-item JSON pages                 |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.operators.dedupe import latest_per_key
from chronoledger.sources.tables import load

# Parameters of the stand-in scenario.
AS_OF_QUEUE = "1995-09-01 00:00:00"   # "now" for the due queue
AS_OF_TREND = "2024-01-30"            # last day of the trend windows
AS_OF_RUNS = "2001-08-01 00:00:00"    # "now" for the runs dashboard
STATE_BEFORE = "1996-01-01 00:00:00"  # orders forming the processing state
EPOCH_TS = "1994-01-01 00:00:00"


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _floor_long(c: Column) -> Column:
    return F.floor(c).cast("bigint")


# -- control tables ------------------------------------------------------
# Projections are written as SQL expression strings (``selectExpr``): one
# call per projection instead of one per column expression.
def targets(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS video_id",
        "c_mktsegment <> 'FURNITURE' AS is_active",
        "CAST(c_nationkey AS INT) AS priority",
        "CAST(24 * (1 + c_custkey % 7) AS INT) AS refresh_interval_hours",
        f"TIMESTAMP_NTZ '{EPOCH_TS}' AS created_at",
        f"TIMESTAMP_NTZ '{EPOCH_TS}' AS updated_at",
    )


def state(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders").where(F.col("o_orderdate") < ts(STATE_BEFORE))
    g = o.groupBy("o_custkey").agg(
        F.max_by(F.struct("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderkey").alias("l"),
        F.expr("min(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END)").alias("first_ok"),
        F.expr("max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END)").alias("last_ok"),
        F.count(F.lit(1)).alias("n"),
    )
    return g.selectExpr(
        "CAST(o_custkey AS STRING) AS video_id",
        "CASE l.o_orderstatus WHEN 'P' THEN 'PROCESSING' WHEN 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "first_ok AS first_processed_at",
        "CASE WHEN l.o_orderstatus = 'P' THEN l.o_orderdate END AS claimed_at",
        "l.o_orderdate AS last_attempt_at",
        "last_ok AS last_succeeded_at",
        "CASE WHEN l.o_orderkey % 10 <> 0 THEN l.o_orderdate END AS next_refresh_at",
        "CAST(n AS BIGINT) AS attempt_count",
        "CAST(l.o_orderkey AS STRING) AS last_ingestion_id",
        "CASE WHEN l.o_orderstatus = 'F' THEN concat('order ', CAST(l.o_orderkey AS STRING), ' failed') END"
        " AS error_message",
    )


def runs(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS ingestion_id",
        f"'{S.RUN_SOURCE_LABEL}' AS channel_handle",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS channel_name",
        "o_orderdate AS started_at",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 5000) END"
        " AS ended_at",
        "CASE o_orderstatus WHEN 'P' THEN 'RUNNING' WHEN 'F' THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status",
        "CASE WHEN o_orderstatus = 'F' THEN concat('run ', CAST(o_orderkey AS STRING), ' incomplete') END"
        " AS error_message",
    )


_STEPS = "array(" + ", ".join(f"'{x}'" for x in S.FETCH_STEPS) + ")"


def outcomes_raw(spark: SparkSession, d: str) -> DataFrame:
    """Step outcomes before dedupe: several lines can report the same step."""
    li = load(spark, d, "lineitem")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.selectExpr(
        "CAST(l_orderkey AS STRING) AS ingestion_id",
        "CAST(o_custkey AS STRING) AS video_id",
        f"element_at({_STEPS}, CAST((l_linenumber - 1) % 4 + 1 AS INT)) AS step",
        "CASE WHEN l_returnflag = 'R' AND (l_linenumber - 1) % 4 = 0 AND l_linestatus = 'O' THEN 'NOT_FOUND'"
        " WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status",
        "l_shipdate AS completed_at",
        "CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN ''"
        " ELSE concat('part ', CAST(l_partkey AS STRING), ' rejected') END END AS error_message",
        "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber",
    )


OUTCOME_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """One outcome per (run, video, step): the latest report wins."""
    raw = outcomes_raw(spark, d)
    keep = [f.name for f in S.INGESTION_STEP_OUTCOMES.fields]
    return latest_per_key(raw, ["ingestion_id", "video_id", "step"], OUTCOME_ORDER, keep=keep)


def handoff(spark: SparkSession, d: str) -> DataFrame:
    """Comments staged by a run for its video: conversation ``c`` was
    fetched by run ``c`` (the order with that key) for that order's customer."""
    c = load(spark, d, "conversations")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = c.join(o, c.conv_id == o.o_orderkey, "inner")
    return j.selectExpr(
        "CAST(o_orderkey AS STRING) AS ingestion_id",
        "CAST(o_custkey AS STRING) AS video_id",
        "concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS comment_id",
    )


# -- silver tables ---------------------------------------------------------
def video_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").selectExpr(
        "CAST(user_id AS STRING) AS video_id",
        "CAST(event_id AS STRING) AS ingestion_id",
        "ts AS collected_at",
        "CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value * 100) AS BIGINT) END AS view_count",
        "CAST(floor(value * 10) AS BIGINT) AS like_count",
        "CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS comment_count",
    )


def channel_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").selectExpr(
        "CAST(user_id % 25 AS STRING) AS channel_id",
        "CAST(event_id AS STRING) AS ingestion_id",
        "ts AS collected_at",
        "CAST(floor(value * 100) AS BIGINT) AS view_count",
        "CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value * 1000) AS BIGINT) END AS subscriber_count",
        "CAST(user_id AS BIGINT) AS video_count",
    )


def videos(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS video_id",
        "CAST(c_nationkey AS STRING) AS channel_id",
        "concat('NATION_', CAST(c_nationkey AS STRING)) AS channel_title",
        "c_name AS title",
        "CAST(NULL AS STRING) AS description",
        "CAST(NULL AS STRING) AS published_at",
        "c_mktsegment AS category_id",
        "array(c_mktsegment) AS tags",
        "CAST(NULL AS STRING) AS duration",
        "'hd' AS definition",
        "'false' AS caption",
        "CAST(floor(c_acctbal) AS BIGINT) AS view_count",
        "CAST(NULL AS BIGINT) AS like_count",
        "CAST(NULL AS BIGINT) AS comment_count",
        "'public' AS privacy_status",
        f"TIMESTAMP_NTZ '{EPOCH_TS}' AS ingested_at",
    )


def channels(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "nation").selectExpr(
        "CAST(n_nationkey AS STRING) AS channel_id",
        "n_name AS title",
        "CAST(NULL AS STRING) AS description",
        "concat('@', lower(n_name)) AS custom_url",
        "CAST(NULL AS STRING) AS published_at",
        "CAST(n_regionkey AS STRING) AS country",
        "CAST(NULL AS BIGINT) AS view_count",
        "CAST(NULL AS BIGINT) AS subscriber_count",
        "CAST(NULL AS BIGINT) AS video_count",
        "concat('UU', CAST(n_nationkey AS STRING)) AS uploads_playlist_id",
        f"TIMESTAMP_NTZ '{EPOCH_TS}' AS ingested_at",
    )


def comments(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "conversations").where("turn = 0").selectExpr(
        "concat('t', CAST(conv_id AS STRING)) AS thread_id",
        "concat(CAST(conv_id AS STRING), '-0') AS comment_id",
        "CAST(NULL AS STRING) AS parent_id",
        "CAST(conv_id AS STRING) AS video_id",
        "role AS author_name",
        "concat('UC', role) AS author_channel_id",
        "text",
        "CAST(length(text) % 50 AS BIGINT) AS like_count",
        "CAST(NULL AS STRING) AS published_at",
        "CAST(NULL AS STRING) AS updated_at",
        "CAST(0 AS BIGINT) AS reply_count",
        f"TIMESTAMP_NTZ '{EPOCH_TS}' AS ingested_at",
    )


def replies(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "conversations").where("turn > 0").selectExpr(
        "concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS comment_id",
        "concat(CAST(conv_id AS STRING), '-0') AS parent_id",
        "CAST(conv_id AS STRING) AS video_id",
        "role AS author_name",
        "concat('UC', role) AS author_channel_id",
        "text",
        "CAST(turn AS BIGINT) AS like_count",
        "CAST(NULL AS STRING) AS published_at",
        "CAST(NULL AS STRING) AS updated_at",
        f"TIMESTAMP_NTZ '{EPOCH_TS}' AS ingested_at",
    )


def tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All stand-in tables by short name (lazy)."""
    return {
        "video_targets": targets(spark, d),
        "video_processing_state": state(spark, d),
        "ingestion_runs": runs(spark, d),
        "ingestion_step_outcomes": outcomes(spark, d),
        "ingestion_comments": handoff(spark, d),
        "video_snapshots": video_snapshots(spark, d),
        "channel_snapshots": channel_snapshots(spark, d),
        "videos": videos(spark, d),
        "channels": channels(spark, d),
        "comments": comments(spark, d),
        "replies": replies(spark, d),
    }


# -- failed requests (error bodies) -----------------------------------------
# Error bodies used by the failed-request stand-in, by (event_id div 12) mod 9.
ERROR_BODIES = (
    '{"error":{"reason":"commentsDisabled"}}',
    '{"error":{"errors":[{"reason":"rateLimitExceeded"}]}}',
    '{"error":{"errors":[{"reason":"quotaExceeded"},{"reason":"other"}]}}',
    "{}",
    "Service Unavailable",
    None,
    '{"error":{"code":403,"errors":[{"reason":"dailyLimitExceeded"}]}}',
    '{"error":{"reason":"userRateLimitExceeded"}}',
    '{"error":"backendError"}',
)
# HTTP status by event_id mod 12 (NULL = no response: transport failure).
ERROR_STATUS = (400, 401, 403, 404, 429, 500, 502, 503, 504, 418, 403, None)


def request_failures(spark: SparkSession, d: str) -> DataFrame:
    """One failed request per event: (attempt_id, video_id, ts, event_type,
    status_code, body)."""
    e = load(spark, d, "events")
    status = F.element_at(F.array(*[F.lit(x).cast("int") for x in ERROR_STATUS]),
                          (F.col("event_id") % 12 + 1).cast("int"))
    body = F.element_at(F.array(*[F.lit(x).cast("string") for x in ERROR_BODIES]),
                        (F.floor(F.col("event_id") / 12) % 9 + 1).cast("int"))
    return e.select(F.col("event_id").alias("attempt_id"), _s("user_id").alias("video_id"), "ts",
                    "event_type", status.alias("status_code"), body.alias("body"))


def candidate_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """Snapshot rows as produced upstream, with NULL and empty ids injected."""
    e = load(spark, d, "events")
    k = F.col("event_id")
    return e.select(
        F.when(k % 17 == 0, F.lit(None).cast("string")).when(k % 19 == 0, F.lit(""))
         .otherwise(_s("user_id")).alias("video_id"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(_s(k)).alias("ingestion_id"),
        F.col("ts").alias("collected_at"),
        _floor_long(F.col("value") * 100).alias("view_count"),
        _floor_long(F.col("value") * 10).alias("like_count"),
        _floor_long(F.col("value")).alias("comment_count"),
    )


def current_videos(spark: SparkSession, d: str, before: str | None, since: str | None,
                   skip_segment: str, ingested_at: str) -> DataFrame:
    """A current-state table: the latest event per user within a time range,
    for users whose customer segment is not ``skip_segment`` (each side of
    a merge knows a different part of the users)."""
    e = load(spark, d, "events")
    if before:
        e = e.where(F.col("ts") < ts(before))
    if since:
        e = e.where(F.col("ts") >= ts(since))
    known = load(spark, d, "customer").where(F.col("c_mktsegment") != skip_segment).select(
        F.col("c_custkey").alias("user_id"))
    e = e.join(known, "user_id", "left_semi")
    rows = e.selectExpr("CAST(user_id AS STRING) AS video_id",
                        "concat(event_type, ' #', CAST(event_id AS STRING)) AS title",
                        "CAST(floor(value * 100) AS BIGINT) AS view_count", "ts", "event_id")
    last = latest_per_key(rows, "video_id", ["ts", "event_id"])
    return last.select("video_id", "title", "view_count", ts(ingested_at).alias("ingested_at"))


def supplier_targets(spark: SparkSession, d: str, at: str) -> DataFrame:
    """New target registrations (one per supplier)."""
    s = load(spark, d, "supplier")
    return s.select(
        F.concat(F.lit("s"), _s("s_suppkey")).alias("video_id"), F.lit(True).alias("is_active"),
        F.col("s_nationkey").cast("int").alias("priority"), F.lit(24).cast("int").alias("refresh_interval_hours"),
        ts(at).alias("created_at"), ts(at).alias("updated_at"))
