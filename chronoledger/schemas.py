"""Table schemas, business keys and status vocabularies.

All twelve tables of the metric-history store are declared here; nothing
is inferred. Column comments live in ``StructField.metadata['comment']`` so a
``CREATE TABLE`` can be generated from the registry (see ``sources.tables``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Timestamps are UTC wall-clock instants stored without a zone.
TS = TimestampNTZType()

# ---------------------------------------------------------------------------
# Fixed values that must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------
# Fetch steps, in the order used to build roll-up messages.
FETCH_STEPS = ("fetch_videos", "fetch_channels", "fetch_comments", "fetch_replies")
# Run status values.
RUN_RUNNING, RUN_SUCCESS, RUN_PARTIAL, RUN_FAILED = "RUNNING", "SUCCESS", "PARTIAL_SUCCESS", "FAILED"
# Target (video) status values.
ST_PROCESSING, ST_SUCCESS, ST_FAILED, ST_NOT_FOUND = "PROCESSING", "SUCCESS", "FAILED", "NOT_FOUND"
# Default texts written by the roll-up and the per-step outcome rules.
MSG_STEP_NOT_DONE = "etapa não concluída"
MSG_VIDEO_NOT_FOUND = "Vídeo não encontrado ou não está acessível"
MSG_CHANNEL_NOT_RETURNED = "Canal do vídeo não foi retornado pela API"
MSG_HTTP_ERROR = "Erro HTTP "
MSG_NETWORK_ERROR = "Falha transitória ao acessar a API do YouTube: "
# Source label of a run opened by the claim step.
RUN_SOURCE_LABEL = "control.video_targets"
# API error categories.
ERROR_CATEGORIES = (
    "AUTHENTICATION", "COMMENTS_DISABLED", "INVALID_REQUEST", "NOT_FOUND",
    "QUOTA_EXCEEDED", "RATE_LIMITED", "TRANSIENT_NETWORK", "TRANSIENT_SERVER", "UNKNOWN",
)
RATE_LIMIT_REASONS = ("rateLimitExceeded", "userRateLimitExceeded")
QUOTA_REASONS = ("dailyLimitExceeded", "quotaExceeded")
TRANSIENT_STATUS_CODES = (429, 500, 502, 503, 504)
RETRYABLE_CATEGORIES = ("RATE_LIMITED", "TRANSIENT_SERVER", "TRANSIENT_NETWORK")
# Ids per API request, stale-claim timeout.
REQUEST_BATCH_SIZE = 50
STALE_CLAIM_INTERVAL = "2 HOURS"
# ---------------------------------------------------------------------------


def _f(name, dtype, nullable=True, comment=None):
    return StructField(name, dtype, nullable, {"comment": comment} if comment else {})


INGESTION_RUNS = StructType([
    _f("ingestion_id", StringType(), False, "run id"),
    _f("channel_handle", StringType(), False, "source label"),
    _f("channel_name", StringType()),
    _f("started_at", TS, False),
    _f("ended_at", TS),
    _f("status", StringType(), False, "RUNNING, SUCCESS, PARTIAL_SUCCESS, FAILED"),
    _f("error_message", StringType()),
])

VIDEO_TARGETS = StructType([
    _f("video_id", StringType(), False),
    _f("is_active", BooleanType(), False),
    _f("priority", IntegerType(), False),
    _f("refresh_interval_hours", IntegerType(), False),
    _f("created_at", TS, False),
    _f("updated_at", TS, False),
])

VIDEO_PROCESSING_STATE = StructType([
    _f("video_id", StringType(), False),
    _f("status", StringType(), False, "PROCESSING, SUCCESS, FAILED, NOT_FOUND"),
    _f("first_processed_at", TS),
    _f("claimed_at", TS),
    _f("last_attempt_at", TS),
    _f("last_succeeded_at", TS),
    _f("next_refresh_at", TS),
    _f("attempt_count", LongType(), False),
    _f("last_ingestion_id", StringType()),
    _f("error_message", StringType()),
])

INGESTION_STEP_OUTCOMES = StructType([
    _f("ingestion_id", StringType(), False),
    _f("video_id", StringType(), False),
    _f("step", StringType(), False),
    _f("status", StringType(), False, "SUCCESS, FAILED, NOT_FOUND"),
    _f("completed_at", TS, False),
    _f("error_message", StringType()),
])

INGESTION_COMMENTS = StructType([
    _f("ingestion_id", StringType(), False),
    _f("video_id", StringType(), False),
    _f("comment_id", StringType(), False),
])

API_RESPONSES = StructType([
    _f("ingestion_id", StringType(), False),
    _f("resource", StringType(), False),
    _f("request_params_json", StringType(), False),
    _f("response_json", StringType(), False),
    _f("received_at", TS, False),
    _f("page_no", LongType(), True),
])

CHANNELS = StructType([
    _f("channel_id", StringType(), False),
    _f("title", StringType()),
    _f("description", StringType()),
    _f("custom_url", StringType()),
    _f("published_at", StringType()),
    _f("country", StringType()),
    _f("view_count", LongType()),
    _f("subscriber_count", LongType()),
    _f("video_count", LongType()),
    _f("uploads_playlist_id", StringType()),
    _f("ingested_at", TS, False),
])

VIDEOS = StructType([
    _f("video_id", StringType(), False),
    _f("channel_id", StringType()),
    _f("channel_title", StringType()),
    _f("title", StringType()),
    _f("description", StringType()),
    _f("published_at", StringType()),
    _f("category_id", StringType()),
    _f("tags", ArrayType(StringType())),
    _f("duration", StringType()),
    _f("definition", StringType()),
    _f("caption", StringType()),
    _f("view_count", LongType()),
    _f("like_count", LongType()),
    _f("comment_count", LongType()),
    _f("privacy_status", StringType()),
    _f("ingested_at", TS, False),
])

COMMENTS = StructType([
    _f("thread_id", StringType()),
    _f("comment_id", StringType(), False),
    _f("parent_id", StringType()),
    _f("video_id", StringType()),
    _f("author_name", StringType()),
    _f("author_channel_id", StringType()),
    _f("text", StringType()),
    _f("like_count", LongType()),
    _f("published_at", StringType()),
    _f("updated_at", StringType()),
    _f("reply_count", LongType()),
    _f("ingested_at", TS, False),
])

REPLIES = StructType([
    _f("comment_id", StringType(), False),
    _f("parent_id", StringType()),
    _f("video_id", StringType()),
    _f("author_name", StringType()),
    _f("author_channel_id", StringType()),
    _f("text", StringType()),
    _f("like_count", LongType()),
    _f("published_at", StringType()),
    _f("updated_at", StringType()),
    _f("ingested_at", TS, False),
])

CHANNEL_SNAPSHOTS = StructType([
    _f("channel_id", StringType(), False),
    _f("ingestion_id", StringType(), False),
    _f("collected_at", TS, False),
    _f("view_count", LongType()),
    _f("subscriber_count", LongType()),
    _f("video_count", LongType()),
])

VIDEO_SNAPSHOTS = StructType([
    _f("video_id", StringType(), False),
    _f("ingestion_id", StringType(), False),
    _f("collected_at", TS, False),
    _f("view_count", LongType()),
    _f("like_count", LongType()),
    _f("comment_count", LongType()),
])

# (layer, table) -> schema
TABLES: dict[tuple[str, str], StructType] = {
    ("control", "ingestion_runs"): INGESTION_RUNS,
    ("control", "video_targets"): VIDEO_TARGETS,
    ("control", "video_processing_state"): VIDEO_PROCESSING_STATE,
    ("control", "ingestion_step_outcomes"): INGESTION_STEP_OUTCOMES,
    ("control", "ingestion_comments"): INGESTION_COMMENTS,
    ("raw", "api_responses"): API_RESPONSES,
    ("silver", "channels"): CHANNELS,
    ("silver", "videos"): VIDEOS,
    ("silver", "comments"): COMMENTS,
    ("silver", "replies"): REPLIES,
    ("silver", "channel_snapshots"): CHANNEL_SNAPSHOTS,
    ("silver", "video_snapshots"): VIDEO_SNAPSHOTS,
}

# Business keys (merge keys). The raw table has none: repeats are possible.
KEYS: dict[str, tuple[str, ...]] = {
    "ingestion_runs": ("ingestion_id",),
    "video_targets": ("video_id",),
    "video_processing_state": ("video_id",),
    "ingestion_step_outcomes": ("ingestion_id", "video_id", "step"),
    "ingestion_comments": ("ingestion_id", "comment_id"),
    "api_responses": (),
    "channels": ("channel_id",),
    "videos": ("video_id",),
    "comments": ("comment_id",),
    "replies": ("comment_id",),
    "channel_snapshots": ("channel_id", "ingestion_id"),
    "video_snapshots": ("video_id", "ingestion_id"),
}

# Metrics projected into the immutable snapshot tables, per entity.
SNAPSHOT_METRICS = {
    "videos": ("video_id", ("view_count", "like_count", "comment_count")),
    "channels": ("channel_id", ("view_count", "subscriber_count", "video_count")),
}


def schema(table: str) -> StructType:
    """Schema of a table by its short name."""
    for (_, name), sch in TABLES.items():
        if name == table:
            return sch
    raise KeyError(table)


def required_columns(table: str) -> list[str]:
    """Columns declared NOT NULL for a table."""
    return [f.name for f in schema(table).fields if not f.nullable]


def ddl(table: str) -> str:
    """DDL column list (with comments) for ``CREATE TABLE``."""
    parts = []
    for f in schema(table).fields:
        piece = f"`{f.name}` {f.dataType.simpleString()}"
        if not f.nullable:
            piece += " NOT NULL"
        if f.metadata.get("comment"):
            piece += " COMMENT '" + f.metadata["comment"].replace("'", "\\'") + "'"
        parts.append(piece)
    return ", ".join(parts)
