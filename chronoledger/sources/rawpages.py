"""Stand-in raw API pages, derived from the test tables.

Each builder turns rows of a test table into API-shaped items and packs
them 50 to a page into ``raw.api_responses`` rows, so the normalisers can be
run over JSON produced at the scale of the input. Optional fields are left
out of an item (NULL fields are not serialised) on fixed rules so that the
missing-field defaults are exercised.

| resource        | from           | item id                | page               |
|-----------------|----------------|------------------------|--------------------|
| videos          | events         | event_id (or user_id)  | event_id div 50    |
| channels        | customer       | 'UC' + custkey         | custkey div 50     |
| commentThreads  | conversations  | 't' + conv_id (turn 0) | conv_id div 50     |
| comments        | conversations  | conv_id-turn (turn>0)  | (8 conv + turn) div 50 |
| playlistItems   | orders         | orderkey               | orderkey div 50    |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoledger.operators.normalize import pack_pages
from chronoledger.sources.tables import load

PAGE = 50


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# Item builders are SQL expressions (one ``expr`` call per item shape).
def _video_item_sql(id_sql: str) -> str:
    return f"""named_struct(
  'id', {id_sql},
  'snippet', named_struct(
     'channelId', CAST(user_id % 25 AS STRING),
     'channelTitle', concat('NATION_', CAST(user_id % 25 AS STRING)),
     'title', concat(event_type, ' #', CAST(event_id AS STRING)),
     'description', props,
     'publishedAt', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
     'categoryId', CAST(user_id % 10 AS STRING),
     'tags', CASE event_id % 3 WHEN 1 THEN CAST(array() AS ARRAY<STRING>)
                               WHEN 2 THEN array(event_type, concat('u', CAST(user_id AS STRING))) END),
  'contentDetails', named_struct(
     'duration', concat('PT', CAST(event_id % 600 AS STRING), 'S'),
     'definition', CASE WHEN event_id % 2 = 0 THEN 'hd' ELSE 'sd' END,
     'caption', 'false'),
  'statistics', CASE WHEN event_id % 13 <> 0 THEN named_struct(
     'viewCount', CAST(floor(value * 100) AS STRING),
     'likeCount', CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value * 10) AS STRING) END,
     'commentCount', CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS STRING) END) END,
  'status', named_struct('privacyStatus', 'public'))"""


def _run_sql(page: str) -> str:
    return f"concat('run-', CAST(floor({page} / 10) AS STRING))"


def video_pages(spark: SparkSession, d: str, id_from: str = "event_id") -> DataFrame:
    """Pages of video items, one item per event (id = event or user id)."""
    items = load(spark, d, "events").selectExpr(
        f"floor(event_id / {PAGE}) AS __page", "event_id AS __order",
        f"{_video_item_sql(f'CAST({id_from} AS STRING)')} AS __item",
        f"CAST({id_from} AS STRING) AS __id", "ts AS __received")
    return pack_pages(items, ["__page"], "videos", "snippet,contentDetails,statistics,status",
                      F.expr(_run_sql("__page")))


def channel_pages(spark: SparkSession, d: str) -> DataFrame:
    items = load(spark, d, "customer").selectExpr(
        f"floor(c_custkey / {PAGE}) AS __page", "c_custkey AS __order",
        """named_struct(
  'id', concat('UC', CAST(c_custkey AS STRING)),
  'snippet', named_struct('title', c_name, 'description', c_mktsegment,
                          'customUrl', concat('@c', CAST(c_custkey AS STRING)),
                          'country', CAST(c_nationkey AS STRING)),
  'statistics', named_struct(
     'viewCount', CAST(floor(c_acctbal) AS STRING),
     'subscriberCount', CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey * 10 AS STRING) END,
     'videoCount', CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 97 AS STRING) END),
  'contentDetails', CASE WHEN c_custkey % 6 <> 0 THEN
     named_struct('relatedPlaylists', named_struct('uploads', concat('UU', CAST(c_custkey AS STRING)))) END
) AS __item""",
        "concat('UC', CAST(c_custkey AS STRING)) AS __id",
        "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS __received")
    return pack_pages(items, ["__page"], "channels", "snippet,statistics,contentDetails",
                      F.expr(_run_sql("__page")))


def _comment_snippet_sql(parent: bool, video: str = "CAST(conv_id AS STRING)") -> str:
    parent_field = "'parentId', concat(CAST(conv_id AS STRING), '-0'), " if parent else ""
    return f"""named_struct('videoId', {video}, {parent_field}
  'authorDisplayName', role,
  'authorChannelId', CASE WHEN conv_id % 4 <> 0 THEN named_struct('value', concat('UC', role)) END,
  'textDisplay', text,
  'likeCount', CASE WHEN conv_id % 5 <> 0 THEN CAST(length(text) % 50 AS BIGINT) END,
  'publishedAt', concat('2024-01-', lpad(CAST(conv_id % 28 + 1 AS STRING), 2, '0'), 'T00:00:00Z'))"""


def thread_pages(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations")
    n_replies = c.groupBy("conv_id").agg((F.count(F.lit(1)) - 1).alias("n_replies"))
    items = c.where("turn = 0").join(n_replies, "conv_id").selectExpr(
        f"floor(conv_id / {PAGE}) AS __page", "conv_id AS __order",
        f"""named_struct('id', concat('t', CAST(conv_id AS STRING)),
  'snippet', named_struct(
     'totalReplyCount', CASE WHEN conv_id % 3 <> 0 THEN CAST(n_replies AS BIGINT) END,
     'topLevelComment', named_struct('id', concat(CAST(conv_id AS STRING), '-0'),
                                     'snippet', {_comment_snippet_sql(False)}))) AS __item""",
        "CAST(conv_id AS STRING) AS __id", "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS __received")
    return pack_pages(items, ["__page"], "commentThreads", "snippet,replies", F.expr(_run_sql("__page")))


def reply_pages(spark: SparkSession, d: str) -> DataFrame:
    items = load(spark, d, "conversations").where("turn > 0").selectExpr(
        f"floor((conv_id * 8 + turn) / {PAGE}) AS __page", "conv_id * 8 + turn AS __order",
        f"""named_struct('id', concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)),
                         'snippet', {_comment_snippet_sql(True)}) AS __item""",
        "concat(CAST(conv_id AS STRING), '-0') AS __id", "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS __received")
    return pack_pages(items, ["__page"], "comments", "snippet", F.expr(_run_sql("__page")))


def playlist_pages(spark: SparkSession, d: str) -> DataFrame:
    items = load(spark, d, "orders").selectExpr(
        f"floor(o_orderkey / {PAGE}) AS __page", "o_orderkey AS __order",
        f"""named_struct(
  'snippet', named_struct('title', concat('order ', CAST(o_orderkey AS STRING)),
                          'description', o_orderpriority, 'position', CAST(o_orderkey % {PAGE} AS BIGINT)),
  'contentDetails', named_struct('videoId', CAST(o_custkey AS STRING),
                                 'videoPublishedAt', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
) AS __item""",
        "CAST(o_orderkey AS STRING) AS __id", "o_orderdate AS __received")
    return pack_pages(items, ["__page"], "playlistItems", "snippet,contentDetails", F.expr(_run_sql("__page")))


# -- pages answering the requests of the stand-in runs ---------------------
def _ts(v: str) -> Column:
    return F.lit(v).cast("timestamp_ntz")


def owned_video_pages(spark: SparkSession, d: str, owned: DataFrame, received: str) -> DataFrame:
    """Video pages per run for its owned targets; customers with a negative
    balance stand in for videos the API no longer returns."""
    c = load(spark, d, "customer").where("c_acctbal >= 0")
    j = owned.select("ingestion_id", "video_id").join(
        c, owned.video_id == c.c_custkey.cast("string"), "inner")
    items = j.selectExpr(
        "ingestion_id", "c_custkey AS __order",
        """named_struct(
  'id', video_id,
  'snippet', named_struct('channelId', CAST(c_nationkey AS STRING),
                          'channelTitle', concat('NATION_', CAST(c_nationkey AS STRING)),
                          'title', concat(c_name, ' (refreshed)'), 'description', c_mktsegment,
                          'categoryId', CAST(c_custkey % 30 AS STRING), 'tags', array(c_mktsegment)),
  'contentDetails', named_struct('duration', 'PT1M', 'definition', 'hd', 'caption', 'false'),
  'statistics', named_struct('viewCount', CAST(floor(c_acctbal * 10) AS STRING),
                             'likeCount', CAST(c_custkey % 100 AS STRING),
                             'commentCount', CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 1000 AS STRING) END),
  'status', named_struct('privacyStatus', 'public')) AS __item""",
        "video_id AS __id", f"TIMESTAMP_NTZ '{received}' AS __received")
    return pack_pages(_paged(items), ["ingestion_id", "__page"], "videos", "snippet,contentDetails,statistics,status",
                      F.col("ingestion_id"))


def run_channel_pages(spark: SparkSession, d: str, video_channels: DataFrame, received: str) -> DataFrame:
    """Channel pages per run for the channels its videos reference; channels
    of region 0 stand in for channels the API did not return."""
    n = load(spark, d, "nation").where("n_regionkey <> 0")
    req = video_channels.select("ingestion_id", "channel_id").distinct()
    j = req.join(n, req.channel_id == n.n_nationkey.cast("string"), "inner")
    items = j.selectExpr(
        "ingestion_id", "n_nationkey AS __order",
        """named_struct(
  'id', channel_id,
  'snippet', named_struct('title', concat(n_name, ' channel'),
                          'description', concat('region ', CAST(n_regionkey AS STRING)),
                          'customUrl', concat('@', lower(n_name)), 'country', CAST(n_regionkey AS STRING)),
  'statistics', named_struct('viewCount', CAST(n_nationkey * 1000 AS STRING),
                             'subscriberCount', CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey * 100 AS STRING) END,
                             'videoCount', CAST(n_nationkey AS STRING)),
  'contentDetails', named_struct('relatedPlaylists',
                                 named_struct('uploads', concat('UU', CAST(n_nationkey AS STRING))))) AS __item""",
        "channel_id AS __id", f"TIMESTAMP_NTZ '{received}' AS __received")
    return pack_pages(_paged(items), ["ingestion_id", "__page"], "channels", "snippet,statistics,contentDetails",
                      F.col("ingestion_id"))


def _paged(items: DataFrame) -> DataFrame:
    """Split a run's items into pages of at most ``PAGE`` items (by item
    order), so no page list is unbounded."""
    return items.withColumn("__page", F.floor(F.col("__order") / PAGE))


def _conv_runs(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "conversations")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return c.join(o, c.conv_id == o.o_orderkey, "inner").selectExpr(
        "conv_id", "turn", "role", "text", "CAST(o_orderkey AS STRING) AS ingestion_id",
        "CAST(o_custkey AS STRING) AS video")


def run_thread_pages(spark: SparkSession, d: str, received: str) -> DataFrame:
    """Comment-thread pages: conversation ``c`` answered run ``c`` for that
    order's customer (turn 0 is the top-level comment)."""
    c = _conv_runs(spark, d)
    n_replies = c.groupBy("conv_id").agg((F.count(F.lit(1)) - 1).alias("n_replies"))
    items = c.where("turn = 0").join(n_replies, "conv_id").selectExpr(
        "ingestion_id", "conv_id AS __order",
        """named_struct('id', concat('t', CAST(conv_id AS STRING)),
  'snippet', named_struct('totalReplyCount', CAST(n_replies AS BIGINT),
     'topLevelComment', named_struct('id', concat(CAST(conv_id AS STRING), '-0'),
        'snippet', named_struct('videoId', video, 'authorDisplayName', role,
                                'authorChannelId', named_struct('value', concat('UC', role)),
                                'textDisplay', text, 'likeCount', CAST(length(text) % 50 AS BIGINT))))) AS __item""",
        "video AS __id", f"TIMESTAMP_NTZ '{received}' AS __received")
    return pack_pages(_paged(items), ["ingestion_id", "__page"], "commentThreads", "snippet,replies", F.col("ingestion_id"))


def run_reply_pages(spark: SparkSession, d: str, received: str) -> DataFrame:
    """Reply pages: turns > 0 of conversation ``c`` reply to comment c-0."""
    items = _conv_runs(spark, d).where("turn > 0").selectExpr(
        "ingestion_id", "conv_id * 8 + turn AS __order",
        """named_struct('id', concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)),
  'snippet', named_struct('parentId', concat(CAST(conv_id AS STRING), '-0'), 'videoId', video,
                          'authorDisplayName', role,
                          'authorChannelId', named_struct('value', concat('UC', role)),
                          'textDisplay', text, 'likeCount', CAST(turn AS BIGINT))) AS __item""",
        "concat(CAST(conv_id AS STRING), '-0') AS __id", f"TIMESTAMP_NTZ '{received}' AS __received")
    return pack_pages(_paged(items), ["ingestion_id", "__page"], "comments", "snippet", F.col("ingestion_id"))


def run_turn_pages(spark: SparkSession, d: str, received: str, size: int) -> DataFrame:
    """Comment-thread pages with a thread for each turn, ``size`` to a page,
    numbered within their run (an order's id is a run's id)."""
    items = _conv_runs(spark, d).selectExpr(
        "ingestion_id", "turn AS __order",
        """named_struct('id', concat('t', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)),
  'snippet', named_struct('totalReplyCount', 0L,
     'topLevelComment', named_struct('id', concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)),
        'snippet', named_struct('videoId', video, 'authorDisplayName', role, 'textDisplay', text)))) AS __item""",
        "video AS __id", f"TIMESTAMP_NTZ '{received}' AS __received", f"CAST(floor(turn / {int(size)}) AS BIGINT) AS __page")
    return pack_pages(items, ["ingestion_id", "__page"], "commentThreads", "snippet,replies", F.col("ingestion_id"))
