"""Independent SQL (DuckDB dialect) for every registered query.

The stand-in tables are re-derived here in plain SQL from the driver's test
tables, then each query is written the way the served SQL states it
(literal range joins, ROW_NUMBER windows, FULL/LEFT/ANTI joins), not the way
the Spark plans compute it. Agreement of the two is the correctness gate.
"""

from __future__ import annotations

STEPS_SQL = "['fetch_videos', 'fetch_channels', 'fetch_comments', 'fetch_replies']"

# Stand-in tables (twins of ``sources.standins``).
CTE = {
    "targets": """SELECT CAST(c_custkey AS VARCHAR) AS video_id, c_mktsegment <> 'FURNITURE' AS is_active,
  CAST(c_nationkey AS INTEGER) AS priority, CAST(24 * (1 + c_custkey % 7) AS INTEGER) AS refresh_interval_hours,
  TIMESTAMP '1994-01-01 00:00:00' AS created_at, TIMESTAMP '1994-01-01 00:00:00' AS updated_at
FROM customer""",
    "state": """SELECT CAST(o_custkey AS VARCHAR) AS video_id,
  CASE st WHEN 'P' THEN 'PROCESSING' WHEN 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  first_ok AS first_processed_at, CASE WHEN st = 'P' THEN dt END AS claimed_at, dt AS last_attempt_at,
  last_ok AS last_succeeded_at, CASE WHEN k % 10 <> 0 THEN dt END AS next_refresh_at,
  CAST(n AS BIGINT) AS attempt_count, CAST(k AS VARCHAR) AS last_ingestion_id,
  CASE WHEN st = 'F' THEN 'order ' || CAST(k AS VARCHAR) || ' failed' END AS error_message
FROM (SELECT o_custkey, max(o_orderkey) AS k, arg_max(o_orderstatus, o_orderkey) AS st,
        arg_max(o_orderdate, o_orderkey) AS dt,
        min(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS first_ok,
        max(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END) AS last_ok, count(*) AS n
      FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' GROUP BY o_custkey) g""",
    "runs": """SELECT CAST(o_orderkey AS VARCHAR) AS ingestion_id, 'control.video_targets' AS channel_handle,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS channel_name, o_orderdate AS started_at,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(CAST(o_orderkey % 5000 AS BIGINT)) END AS ended_at,
  CASE o_orderstatus WHEN 'P' THEN 'RUNNING' WHEN 'F' THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN 'run ' || CAST(o_orderkey AS VARCHAR) || ' incomplete' END AS error_message
FROM orders""",
    "outcomes_raw": f"""SELECT CAST(l_orderkey AS VARCHAR) AS ingestion_id, CAST(o_custkey AS VARCHAR) AS video_id,
  {STEPS_SQL}[(l_linenumber - 1) % 4 + 1] AS step,
  CASE WHEN l_returnflag = 'R' AND (l_linenumber - 1) % 4 = 0 AND l_linestatus = 'O' THEN 'NOT_FOUND'
       WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  l_shipdate AS completed_at,
  CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN ''
       ELSE 'part ' || CAST(l_partkey AS VARCHAR) || ' rejected' END END AS error_message,
  l_shipdate, l_partkey, l_suppkey, l_linenumber
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "outcomes": """SELECT ingestion_id, video_id, step, status, completed_at, error_message FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ingestion_id, video_id, step
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_linenumber DESC) AS rn
  FROM outcomes_raw) WHERE rn = 1""",
    "handoff": """SELECT CAST(o_orderkey AS VARCHAR) AS ingestion_id, CAST(o_custkey AS VARCHAR) AS video_id,
  CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id
FROM conversations JOIN orders ON conv_id = o_orderkey""",
    "vsnap": """SELECT CAST(user_id AS VARCHAR) AS video_id, CAST(event_id AS VARCHAR) AS ingestion_id, ts AS collected_at,
  CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value * 100) AS BIGINT) END AS view_count,
  CAST(floor(value * 10) AS BIGINT) AS like_count,
  CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) END AS comment_count
FROM events""",
    "csnap": """SELECT CAST(user_id % 25 AS VARCHAR) AS channel_id, CAST(event_id AS VARCHAR) AS ingestion_id,
  ts AS collected_at, CAST(floor(value * 100) AS BIGINT) AS view_count,
  CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value * 1000) AS BIGINT) END AS subscriber_count,
  CAST(user_id AS BIGINT) AS video_count
FROM events""",
    "videos": """SELECT CAST(c_custkey AS VARCHAR) AS video_id, CAST(c_nationkey AS VARCHAR) AS channel_id,
  'NATION_' || CAST(c_nationkey AS VARCHAR) AS channel_title, c_name AS title,
  CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS published_at, c_mktsegment AS category_id,
  [c_mktsegment] AS tags, CAST(NULL AS VARCHAR) AS duration, 'hd' AS definition, 'false' AS caption,
  CAST(floor(c_acctbal) AS BIGINT) AS view_count, CAST(NULL AS BIGINT) AS like_count,
  CAST(NULL AS BIGINT) AS comment_count, 'public' AS privacy_status,
  TIMESTAMP '1994-01-01 00:00:00' AS ingested_at
FROM customer""",
    "channels": """SELECT CAST(n_nationkey AS VARCHAR) AS channel_id, n_name AS title, CAST(NULL AS VARCHAR) AS description,
  '@' || lower(n_name) AS custom_url, CAST(NULL AS VARCHAR) AS published_at, CAST(n_regionkey AS VARCHAR) AS country,
  CAST(NULL AS BIGINT) AS view_count, CAST(NULL AS BIGINT) AS subscriber_count, CAST(NULL AS BIGINT) AS video_count,
  'UU' || CAST(n_nationkey AS VARCHAR) AS uploads_playlist_id, TIMESTAMP '1994-01-01 00:00:00' AS ingested_at
FROM nation""",
    "comments": """SELECT 't' || CAST(conv_id AS VARCHAR) AS thread_id, CAST(conv_id AS VARCHAR) || '-0' AS comment_id,
  CAST(NULL AS VARCHAR) AS parent_id, CAST(conv_id AS VARCHAR) AS video_id, role AS author_name,
  'UC' || role AS author_channel_id, text, CAST(length(text) % 50 AS BIGINT) AS like_count,
  CAST(NULL AS VARCHAR) AS published_at, CAST(NULL AS VARCHAR) AS updated_at, CAST(0 AS BIGINT) AS reply_count,
  TIMESTAMP '1994-01-01 00:00:00' AS ingested_at
FROM conversations WHERE turn = 0""",
    "replies": """SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS comment_id,
  CAST(conv_id AS VARCHAR) || '-0' AS parent_id, CAST(conv_id AS VARCHAR) AS video_id, role AS author_name,
  'UC' || role AS author_channel_id, text, CAST(turn AS BIGINT) AS like_count,
  CAST(NULL AS VARCHAR) AS published_at, CAST(NULL AS VARCHAR) AS updated_at,
  TIMESTAMP '1994-01-01 00:00:00' AS ingested_at
FROM conversations WHERE turn > 0""",
    "active": "SELECT DISTINCT video_id FROM targets WHERE is_active",
    "vmetrics": """SELECT s.video_id, v.title AS video_title, v.channel_id, v.channel_title, s.collected_at,
  s.view_count, s.like_count, s.comment_count, s.ingestion_id
FROM vsnap s LEFT JOIN videos v ON s.video_id = v.video_id""",
    "cmetrics": """SELECT s.channel_id, c.title AS channel_title, s.collected_at, s.view_count, s.subscriber_count,
  s.video_count, s.ingestion_id
FROM csnap s LEFT JOIN channels c ON s.channel_id = c.channel_id""",
    "vtargets": """SELECT t.video_id, t.is_active, t.priority, t.refresh_interval_hours, s.status, s.last_succeeded_at,
  s.next_refresh_at, s.attempt_count, s.error_message
FROM targets t LEFT JOIN state s ON t.video_id = s.video_id""",
}

_STEPS = ["fetch_videos", "fetch_channels", "fetch_comments", "fetch_replies"]
_NOT_DONE = "etapa não concluída"
CTE["owned"] = """SELECT s.last_ingestion_id AS ingestion_id, t.video_id, t.refresh_interval_hours
FROM targets t JOIN state s ON t.video_id = s.video_id WHERE s.status = 'PROCESSING'"""
CTE["piv"] = ("SELECT ingestion_id, video_id, " + ", ".join(
    f"max(CASE WHEN step = '{x}' THEN status END) AS {x}_status, "
    f"max(CASE WHEN step = '{x}' THEN error_message END) AS {x}_error" for x in _STEPS)
    + " FROM outcomes GROUP BY ingestion_id, video_id")
_fail = lambda x: f"coalesce(p.{x}_status, 'FAILED') <> 'SUCCESS'"
_any_fail = " OR ".join(_fail(x) for x in _STEPS)
_text = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN {_fail(x)} THEN '{x}: ' || coalesce(nullif(p.{x}_error, ''), '{_NOT_DONE}') END"
    for x in _STEPS) + ")"
CTE["fin"] = f"""SELECT o.ingestion_id, o.video_id, o.refresh_interval_hours,
  CASE WHEN p.fetch_videos_status = 'NOT_FOUND' THEN 'NOT_FOUND' WHEN {_any_fail} THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN p.fetch_videos_status = 'NOT_FOUND' THEN p.fetch_videos_error WHEN {_any_fail} THEN {_text} END AS error_message
FROM owned o LEFT JOIN piv p ON o.ingestion_id = p.ingestion_id AND o.video_id = p.video_id"""

CTE["failures"] = """SELECT event_id AS attempt_id, CAST(user_id AS VARCHAR) AS video_id, ts, event_type,
  CAST([400, 401, 403, 404, 429, 500, 502, 503, 504, 418, 403, NULL][event_id % 12 + 1] AS INTEGER) AS status_code,
  ['{"error":{"reason":"commentsDisabled"}}', '{"error":{"errors":[{"reason":"rateLimitExceeded"}]}}',
   '{"error":{"errors":[{"reason":"quotaExceeded"},{"reason":"other"}]}}', '{}', 'Service Unavailable', NULL,
   '{"error":{"code":403,"errors":[{"reason":"dailyLimitExceeded"}]}}', '{"error":{"reason":"userRateLimitExceeded"}}',
   '{"error":"backendError"}'][(event_id // 12) % 9 + 1] AS body
FROM events"""
CTE["classified"] = """SELECT *, '[' || category || '] ' || CASE WHEN status_code IS NULL THEN 'Falha transitória ao acessar a API do YouTube: '
    ELSE 'Erro HTTP ' || CAST(status_code AS VARCHAR) || ': ' END || coalesce(body, '') AS message,
  category IN ('RATE_LIMITED', 'TRANSIENT_SERVER', 'TRANSIENT_NETWORK') AS retryable
FROM (SELECT *, CASE
    WHEN list_contains(reasons, 'commentsDisabled') THEN 'COMMENTS_DISABLED'
    WHEN list_has_any(reasons, ['rateLimitExceeded', 'userRateLimitExceeded']) OR status_code = 429 THEN 'RATE_LIMITED'
    WHEN list_has_any(reasons, ['dailyLimitExceeded', 'quotaExceeded']) THEN 'QUOTA_EXCEEDED'
    WHEN status_code IN (401, 403) THEN 'AUTHENTICATION'
    WHEN status_code = 404 THEN 'NOT_FOUND'
    WHEN status_code = 400 THEN 'INVALID_REQUEST'
    WHEN status_code IN (500, 502, 503, 504) THEN 'TRANSIENT_SERVER'
    WHEN status_code IS NULL THEN 'TRANSIENT_NETWORK'
    ELSE 'UNKNOWN' END AS category
  FROM (SELECT *, CASE WHEN body IS NOT NULL AND json_valid(body) THEN list_filter(list_concat(
      coalesce(CAST(json_extract_string(body, '$.error.errors[*].reason') AS VARCHAR[]), []),
      [json_extract_string(body, '$.error.reason')]), lambda r: r IS NOT NULL AND r <> '') ELSE [] END AS reasons
    FROM failures) a) b"""
CTE["cand"] = """SELECT CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS video_id,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS ingestion_id, ts AS collected_at,
  CAST(floor(value * 100) AS BIGINT) AS view_count, CAST(floor(value * 10) AS BIGINT) AS like_count,
  CAST(floor(value) AS BIGINT) AS comment_count
FROM events"""
CTE["newtargets"] = """SELECT 's' || CAST(s_suppkey AS VARCHAR) AS video_id, true AS is_active, CAST(s_nationkey AS INTEGER) AS priority,
  CAST(24 AS INTEGER) AS refresh_interval_hours, TIMESTAMP '1995-09-01 00:00:00' AS created_at,
  TIMESTAMP '1995-09-01 00:00:00' AS updated_at FROM supplier"""

# dependencies between stand-ins (emitted in this order)
ORDER = ["targets", "state", "runs", "outcomes_raw", "outcomes", "handoff", "vsnap", "csnap",
         "videos", "channels", "comments", "replies", "active", "vmetrics", "cmetrics", "vtargets",
         "owned", "piv", "fin", "failures", "classified", "cand", "newtargets"]


def with_ctes(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the stand-in CTEs it mentions (plus ``extra``)."""
    import re

    extra = extra or []
    text = body + " ".join(sql for _, sql in extra)
    need: set[str] = set()

    def visit(name):
        if name in need:
            return
        need.add(name)
        for other in ORDER:
            if other != name and re.search(rf"\b{other}\b", CTE[name]):
                visit(other)

    for name in ORDER:
        if re.search(rf"\b{name}\b", text):
            visit(name)
    parts = [f"{n} AS ({CTE[n]})" for n in ORDER if n in need]
    parts += [f"{n} AS ({sql})" for n, sql in extra]
    if not parts:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def calendar_sql(as_of: str, days: int, name: str = "collected_date") -> str:
    return (f"SELECT CAST(x AS DATE) AS {name} FROM generate_series("
            f"DATE '{as_of}' - INTERVAL {days - 1} DAYS, DATE '{as_of}', INTERVAL 1 DAY) g(x)")
