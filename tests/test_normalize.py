"""JSON normalisers, error classification, bounded prefixes, handles."""

import datetime as dt
import json

from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.functions.columns import strip_handle
from chronoledger.functions.errors import classify_error
from chronoledger.operators import normalize as N
from chronoledger.operators.topn import bounded_per_group

RAW = "ingestion_id string, resource string, request_params_json string, response_json string, received_at timestamp_ntz"


def raw_rows(spark, resource, pages):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("r1", resource, "{}", json.dumps(p), t + dt.timedelta(seconds=i))
                                  for i, p in enumerate(pages)], RAW)


def test_video_defaults_and_paging(spark):
    pages = [{"items": [{"id": "a", "snippet": {"tags": ["x"]}, "statistics": {"viewCount": "12345678901234"}}],
              "nextPageToken": "p2"},
             {"items": [{"id": "b"}]}, {"kind": "empty page"}]
    v = N.normalize_videos(raw_rows(spark, "videos", pages)).orderBy("received_at").collect()
    assert [r.video_id for r in v] == ["a", "b"]
    assert v[0].view_count == 12345678901234 and v[0].like_count is None and v[0].tags == ["x"]
    assert v[1].view_count == 0 and v[1].tags == [] and v[1].comment_count is None


def test_threads_without_most_fields(spark):
    pages = [{"items": [{"id": "t9", "snippet": {"totalReplyCount": 4, "topLevelComment": {"snippet": {"likeCount": 2}}}},
                        {"snippet": {"topLevelComment": {"id": "lone"}}}, {}]}]
    rows = N.normalize_comments(raw_rows(spark, "commentThreads", pages)).orderBy("item_pos").collect()
    assert [(r.thread_id, r.comment_id, r.like_count, r.reply_count) for r in rows] == [
        ("t9", None, 2, 4), (None, "lone", 0, 0), (None, None, 0, 0)]


def test_items_keep_page_and_place(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("r1", "comments", "{}", json.dumps({"items": [{"id": f"{p}{i}"} for i in range(2)]}), t, p) for p in (1, 0)]
    raw = spark.createDataFrame(rows, RAW + ", page_no bigint")
    assert [r.comment_id for r in N.normalize_replies(raw).orderBy("page_no", "item_pos").collect()] == ["00", "01", "10", "11"]


def test_channel_hidden_subscribers(spark):
    pages = [{"items": [{"id": "UC1", "statistics": {"viewCount": "5"},
                         "contentDetails": {"relatedPlaylists": {"uploads": "UU1"}}}]}]
    c = N.normalize_channels(raw_rows(spark, "channels", pages)).collect()[0]
    assert (c.view_count, c.subscriber_count, c.video_count, c.uploads_playlist_id) == (5, None, 0, "UU1")


def test_secret_not_stored(spark):
    df = spark.createDataFrame([({"key": "SECRET", "part": "snippet", "id": "a,b"},)], "p map<string,string>")
    s = df.select(N.sorted_json_map(F.col("p")).alias("j")).collect()[0].j
    assert "SECRET" not in s and json.loads(s) == {"id": "a,b", "part": "snippet"}
    assert list(json.loads(s)) == sorted(json.loads(s))


def test_error_classes(spark):
    cases = [
        (403, '{"error":{"reason":"commentsDisabled"}}', "COMMENTS_DISABLED", False),
        (429, '{"error":{"errors":[{"reason":"rateLimitExceeded"}]}}', "RATE_LIMITED", True),
        (403, '{"error":{"errors":[{"reason":"quotaExceeded"}]}}', "QUOTA_EXCEEDED", False),
        (403, "{}", "AUTHENTICATION", False),
        (401, "{}", "AUTHENTICATION", False),
        (404, "whatever", "NOT_FOUND", False),
        (400, "{}", "INVALID_REQUEST", False),
        (503, "", "TRANSIENT_SERVER", True),
        (502, "not json", "TRANSIENT_SERVER", True),
        (418, None, "UNKNOWN", False),
        (None, None, "TRANSIENT_NETWORK", True),
    ]
    df = spark.createDataFrame([(c[0], c[1]) for c in cases], "status int, body string")
    got = [(r.c.category, r.c.retryable, r.c.message) for r in
           df.select(classify_error("status", "body").alias("c")).collect()]
    for (code, body, cat, retry), (gcat, gretry, msg) in zip(cases, got):
        assert (gcat, gretry) == (cat, retry), (code, body)
        assert msg.startswith(f"[{cat}] ")


def test_error_texts(spark):
    df = spark.createDataFrame([(500, "down"), (None, "timed out"), (404, None)], "status int, body string")
    got = [r.m for r in df.select(classify_error("status", "body")["message"].alias("m")).collect()]
    assert got == [f"[TRANSIENT_SERVER] {S.MSG_HTTP_ERROR}500: down", f"[TRANSIENT_NETWORK] {S.MSG_NETWORK_ERROR}timed out",
                   f"[NOT_FOUND] {S.MSG_HTTP_ERROR}404: "]


def test_prefix_of_each_group(spark):
    df = spark.createDataFrame([(g, o) for g in "xyz" for o in range(ord(g) - ord("w"))], "g string, o int")
    for n, want in ((0, 6), (1, 3), (2, 5), (9, 6)):
        rows = bounded_per_group(df, "g", ["o"], n).collect()
        assert len(rows) == want and all(r.o < (n or 9) for r in rows)


def test_handle(spark):
    df = spark.createDataFrame([("@example",), ("plain",), ("@@x",)], "h string")
    assert [r.n for r in df.select(strip_handle("h").alias("n")).collect()] == ["example", "plain", "@x"]
