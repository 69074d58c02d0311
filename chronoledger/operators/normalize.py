"""Raw API pages -> typed current-state rows, as set-based Spark jobs.

The raw table keeps every successful response page as JSON text. These
operators reprocess it: filter by resource, parse the page, explode its
``items`` (keeping page order), and project each item to its silver row.
Defaults follow the source's rules: view and channel-video counters default
to 0 when missing, likes / comments / subscribers stay NULL when missing;
tags default to an empty array; comment likes and reply counts to 0.
(``from_json`` cannot tell a missing key from an explicit JSON null, so the
default applies to both.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.functions.columns import counter

PAGE_SCHEMA = "struct<items: array<string>, nextPageToken: string>"

VIDEO_ITEM = ("struct<id: string, snippet: struct<channelId: string, channelTitle: string, title: string, "
              "description: string, publishedAt: string, categoryId: string, tags: array<string>>, "
              "contentDetails: struct<duration: string, definition: string, caption: string>, "
              "statistics: struct<viewCount: string, likeCount: string, commentCount: string>, "
              "status: struct<privacyStatus: string>>")
CHANNEL_ITEM = ("struct<id: string, snippet: struct<title: string, description: string, customUrl: string, "
                "publishedAt: string, country: string>, statistics: struct<viewCount: string, "
                "subscriberCount: string, videoCount: string>, "
                "contentDetails: struct<relatedPlaylists: struct<uploads: string>>>")
_COMMENT_SNIPPET = ("struct<videoId: string, parentId: string, authorDisplayName: string, "
                    "authorChannelId: struct<value: string>, textDisplay: string, likeCount: bigint, "
                    "publishedAt: string, updatedAt: string>")
THREAD_ITEM = (f"struct<id: string, snippet: struct<totalReplyCount: bigint, "
               f"topLevelComment: struct<id: string, snippet: {_COMMENT_SNIPPET}>>>")
REPLY_ITEM = f"struct<id: string, snippet: {_COMMENT_SNIPPET}>"
PLAYLIST_ITEM = ("struct<snippet: struct<title: string, description: string, position: bigint>, "
                 "contentDetails: struct<videoId: string, videoPublishedAt: string>>")


def raw_flatten(raw: DataFrame, resource: str | None = None) -> DataFrame:
    """One row per item of every stored page: ingestion_id, resource,
    received_at, page_no (the page's place in its request; 0 where a page
    was stored without one), item_pos (position in its page), item_json.
    Pages without ``items`` (or unparseable pages) contribute no rows."""
    r = raw if resource is None else raw.where(F.col("resource") == resource)
    page = F.from_json(F.col("response_json"), PAGE_SCHEMA)
    number = F.coalesce(F.col("page_no"), F.lit(0)) if "page_no" in raw.columns else F.lit(0)
    return r.select("ingestion_id", "resource", "received_at", number.cast("bigint").alias("page_no"),
                    F.posexplode(page["items"]).alias("item_pos", "item_json"))


def parse_items(raw: DataFrame, resource: str, item_schema: str) -> DataFrame:
    """Flattened items of one resource parsed with ``item_schema`` as ``item``."""
    return raw_flatten(raw, resource).select(
        "ingestion_id", "received_at", "page_no", "item_pos", F.from_json("item_json", item_schema).alias("item"))


def video_columns(item: Column) -> list[Column]:
    sn, cd, st = item["snippet"], item["contentDetails"], item["statistics"]
    return [
        item["id"].alias("video_id"),
        sn["channelId"].alias("channel_id"),
        sn["channelTitle"].alias("channel_title"),
        sn["title"].alias("title"),
        sn["description"].alias("description"),
        sn["publishedAt"].alias("published_at"),
        sn["categoryId"].alias("category_id"),
        F.coalesce(sn["tags"], F.array().cast("array<string>")).alias("tags"),
        cd["duration"].alias("duration"),
        cd["definition"].alias("definition"),
        cd["caption"].alias("caption"),
        counter(st["viewCount"], True).alias("view_count"),
        counter(st["likeCount"], False).alias("like_count"),
        counter(st["commentCount"], False).alias("comment_count"),
        item["status"]["privacyStatus"].alias("privacy_status"),
    ]


def channel_columns(item: Column) -> list[Column]:
    sn, st = item["snippet"], item["statistics"]
    return [
        item["id"].alias("channel_id"),
        sn["title"].alias("title"),
        sn["description"].alias("description"),
        sn["customUrl"].alias("custom_url"),
        sn["publishedAt"].alias("published_at"),
        sn["country"].alias("country"),
        counter(st["viewCount"], True).alias("view_count"),
        counter(st["subscriberCount"], False).alias("subscriber_count"),
        counter(st["videoCount"], True).alias("video_count"),
        item["contentDetails"]["relatedPlaylists"]["uploads"].alias("uploads_playlist_id"),
    ]


def comment_columns(item: Column) -> list[Column]:
    top = item["snippet"]["topLevelComment"]
    sn = top["snippet"]
    return [
        item["id"].alias("thread_id"),
        top["id"].alias("comment_id"),
        F.lit(None).cast("string").alias("parent_id"),
        sn["videoId"].alias("video_id"),
        sn["authorDisplayName"].alias("author_name"),
        sn["authorChannelId"]["value"].alias("author_channel_id"),
        sn["textDisplay"].alias("text"),
        F.coalesce(sn["likeCount"], F.lit(0).cast("bigint")).alias("like_count"),
        sn["publishedAt"].alias("published_at"),
        sn["updatedAt"].alias("updated_at"),
        F.coalesce(item["snippet"]["totalReplyCount"], F.lit(0).cast("bigint")).alias("reply_count"),
    ]


def reply_columns(item: Column) -> list[Column]:
    sn = item["snippet"]
    return [
        item["id"].alias("comment_id"),
        sn["parentId"].alias("parent_id"),
        sn["videoId"].alias("video_id"),
        sn["authorDisplayName"].alias("author_name"),
        sn["authorChannelId"]["value"].alias("author_channel_id"),
        sn["textDisplay"].alias("text"),
        F.coalesce(sn["likeCount"], F.lit(0).cast("bigint")).alias("like_count"),
        sn["publishedAt"].alias("published_at"),
        sn["updatedAt"].alias("updated_at"),
    ]


def playlist_item_columns(item: Column) -> list[Column]:
    sn, cd = item["snippet"], item["contentDetails"]
    return [
        cd["videoId"].alias("video_id"),
        sn["title"].alias("title"),
        sn["description"].alias("description"),
        cd["videoPublishedAt"].alias("published_at"),
        sn["position"].alias("playlist_position"),
    ]


_RESOURCES = {
    "videos": (VIDEO_ITEM, video_columns),
    "channels": (CHANNEL_ITEM, channel_columns),
    "commentThreads": (THREAD_ITEM, comment_columns),
    "comments": (REPLY_ITEM, reply_columns),
    "playlistItems": (PLAYLIST_ITEM, playlist_item_columns),
}


def normalize(raw: DataFrame, resource: str, keep_meta: bool = True) -> DataFrame:
    """Normalised rows of one resource from the raw table.

    With ``keep_meta`` the run id, receive time, page and position are kept
    (they order items, and repeated fetches of one entity)."""
    schema, cols = _RESOURCES[resource]
    items = parse_items(raw, resource, schema)
    meta = [F.col(c) for c in ("ingestion_id", "received_at", "page_no", "item_pos")] if keep_meta else []
    return items.select(*meta, *cols(F.col("item")))


def normalize_videos(raw: DataFrame, **kw) -> DataFrame:
    return normalize(raw, "videos", **kw)


def normalize_channels(raw: DataFrame, **kw) -> DataFrame:
    return normalize(raw, "channels", **kw)


def normalize_comments(raw: DataFrame, **kw) -> DataFrame:
    return normalize(raw, "commentThreads", **kw)


def normalize_replies(raw: DataFrame, **kw) -> DataFrame:
    return normalize(raw, "comments", **kw)


def normalize_playlist_items(raw: DataFrame, **kw) -> DataFrame:
    return normalize(raw, "playlistItems", **kw)


# -- packing (the inverse: how pages are stored) --------------------------
def sorted_json_map(params: Column, drop_keys=("key",)) -> Column:
    """JSON text of a string map with keys sorted and secrets removed."""
    kept = F.map_filter(params, lambda k, v: ~k.isin(*drop_keys))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept))))


def _sorted_json_map_sql(map_sql: str, drop_keys=("key",)) -> str:
    dropped = ", ".join(f"'{k}'" for k in drop_keys)
    return (f"to_json(map_from_entries(array_sort(map_entries("
            f"map_filter({map_sql}, (k, v) -> NOT k IN ({dropped}))))))")


def pack_pages(items: DataFrame, page_cols, resource: str, part: str, ingestion_id: Column,
               page_size: int = 50) -> DataFrame:
    """Group items into stored pages (one raw row per page), as the fetch
    step would have received them.

    ``items`` carries ``__order`` (item order in its page), ``__item`` (a
    struct serialised as the item JSON; NULL fields are omitted, i.e.
    missing), ``__id`` (the requested id) and ``__received`` (receive
    time). Callers bound a page by ``page_cols`` to at most ``page_size``
    items, so each per-page list is bounded; the last of ``page_cols`` is the
    page's number in its request. ``ingestion_id`` is an
    expression over ``page_cols``. Request parameters are stored as JSON with
    sorted keys and without the API key."""
    g = items.groupBy(*page_cols).agg(
        F.expr("array_sort(collect_list(named_struct('o', __order, 'j', to_json(__item))))").alias("__items"),
        F.expr("max(__received)").alias("received_at"),
        F.expr("array_join(array_sort(collect_list(CAST(__id AS STRING))), ',')").alias("__ids"))
    params = (f"map('id', __ids, 'part', '{part}', 'maxResults', '{int(page_size)}', "
              f"'key', '<api-key>')")
    return g.select(
        ingestion_id.cast("string").alias("ingestion_id"),
        F.lit(resource).alias("resource"),
        F.expr(_sorted_json_map_sql(params)).alias("request_params_json"),
        F.expr("concat('{\"items\":[', array_join(transform(__items, x -> x.j), ','), ']}')").alias("response_json"),
        F.col("received_at"),
        F.col(page_cols[-1]).cast("bigint").alias("page_no"),
    )
