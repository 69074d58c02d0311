"""The raw table read as a stream and merged per micro-batch."""

import datetime as dt
import json
import os
import tempfile

from chronoledger import schemas as S
from chronoledger.sources.tables import TableStore
from chronoledger.streaming import raw_stream


def test_foreach_batch_upsert(spark):
    root = tempfile.mkdtemp(prefix="cl-stream-")
    store = TableStore(spark, os.path.join(root, "store"))
    store.create_all()
    raw_dir = os.path.join(root, "raw")
    t = dt.datetime(2024, 1, 1)
    first = [("r1", "videos", "{}", json.dumps({"items": [{"id": "a", "statistics": {"viewCount": "1"}},
                                                          {"id": "b"}]}), t, 0)]
    spark.createDataFrame(first, S.API_RESPONSES).write.partitionBy("resource").mode("append").parquet(raw_dir)
    q = raw_stream.start(spark, raw_dir, store, os.path.join(root, "ckpt"), resources=("videos",))
    q.awaitTermination(120)
    second = [("r2", "videos", "{}", json.dumps({"items": [{"id": "a", "statistics": {"viewCount": "7"}}]}),
               t + dt.timedelta(hours=1), 0)]
    spark.createDataFrame(second, S.API_RESPONSES).write.partitionBy("resource").mode("append").parquet(raw_dir)
    q = raw_stream.start(spark, raw_dir, store, os.path.join(root, "ckpt"), resources=("videos",))
    q.awaitTermination(120)
    cur = {r.video_id: r.view_count for r in store.read("silver", "videos").collect()}
    assert cur == {"a": 7, "b": 0}
    before = store.versions("silver", "channels")
    # an older page comes late: what is newer stays, what is new is added
    late = [("r0", "videos", "{}", json.dumps({"items": [{"id": "a", "statistics": {"viewCount": "3"}}, {"id": "c"}]}),
             t - dt.timedelta(days=1), 0)]
    spark.createDataFrame(late, S.API_RESPONSES).write.partitionBy("resource").mode("append").parquet(raw_dir)
    q = raw_stream.start(spark, raw_dir, store, os.path.join(root, "ckpt"))
    q.awaitTermination(120)
    cur = {r.video_id: r.view_count for r in store.read("silver", "videos").collect()}
    assert cur == {"a": 7, "b": 0, "c": 0}
    assert store.versions("silver", "channels") == before  # no pages, no new version


def _write(spark, raw_dir, rows):
    spark.createDataFrame(rows, S.API_RESPONSES).write.partitionBy("resource").mode("append").parquet(raw_dir)


def test_stream_and_batch_compare_receive_times(spark):
    """A page received before a batch run's time, but after what the run read, is newer than that."""
    from chronoledger.plans import ingest as IG

    root = tempfile.mkdtemp(prefix="cl-stream-")
    store = TableStore(spark, os.path.join(root, "store"), buckets=4)
    store.create_all()
    store.publish("control", "video_targets", spark.createDataFrame([("a", True, 1, 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))], S.VIDEO_TARGETS))

    def page(run, views, minute):
        return (run, "videos", "{}", json.dumps({"items": [{"id": "a", "statistics": {"viewCount": str(views)}}]}), dt.datetime(2024, 1, 1, 11, minute), 0)
    tables = {t: store.read(layer, t) for (layer, t) in S.TABLES}
    owned = spark.createDataFrame([("r1", "a", 1)], "ingestion_id string, video_id string, refresh_interval_hours long")
    new, _ = IG.apply_videos(tables, spark.createDataFrame([page("r1", 1, 50)], S.API_RESPONSES), "2024-01-01 12:00:00", owned)
    IG._cut(new, {"videos"}, store)
    for views, minute, want in ((2, 55, 2), (3, 40, 2)):
        raw_stream.merge_batch(store, spark.createDataFrame([page("r2", views, minute)], S.API_RESPONSES), "videos")
        assert [r.view_count for r in store.read("silver", "videos").collect()] == [want]


def test_streamed_steps_equal_the_batch(spark):
    """Snapshots, hand-off, outcomes and entities of a run are those of the batch, in two orders of pages and with a replay."""
    from chronoledger.plans import ingest as IG
    from chronoledger.operators.queue import owned_targets
    from tests.test_ingest import raw_for

    t0, at = dt.datetime(2024, 1, 1), "2024-01-01 00:00:00"
    pages = {r.resource: tuple(r) for r in raw_for(spark, "run1", t0, 9).collect()}
    kept = ["videos", "video_snapshots", "channels", "channel_snapshots", "comments", "replies", "ingestion_comments", "ingestion_step_outcomes"]

    def claimed():
        store = TableStore(spark, tempfile.mkdtemp(prefix="cl-store-"), buckets=2)
        store.create_all()
        store.publish("control", "video_targets", spark.createDataFrame([(v, True, 1, 1, t0, t0) for v in ("v1", "v2", "v3")], S.VIDEO_TARGETS))
        tables, _ = IG.claim({t: store.read(layer, t) for (layer, t) in S.TABLES if t != "api_responses"}, "run1", at, 10)
        IG._cut(tables, set(tables[IG.CHANGES]), store)
        return store

    def content(store):
        return {t: sorted(map(str, store.read(layer, t).collect())) for (layer, t) in S.TABLES if t in kept}
    store = claimed()
    raw = spark.createDataFrame(list(pages.values()), S.API_RESPONSES)
    for step in raw_stream.STEPS.values():
        tables = {t: store.read(layer, t) for (layer, t) in S.TABLES if t != "api_responses"}
        new, _ = step(tables, raw, at, owned_targets(tables["video_targets"], tables["video_processing_state"]))
        IG._cut(new, set(new[IG.CHANGES]), store)
    want = content(store)
    assert all(want[t] for t in kept)
    for order in ((["videos", "channels", "commentThreads", "comments"],), (["comments", "commentThreads"], ["channels"], ["videos"])):
        store, root = claimed(), tempfile.mkdtemp(prefix="cl-stream-")
        for resources in order:
            _write(spark, os.path.join(root, "raw"), [pages[r] for r in resources])
            raw_stream.start_steps(spark, os.path.join(root, "raw"), store, os.path.join(root, "ckpt"), at).awaitTermination(300)
        assert content(store) == want, order
    raw_stream.step_batch(store, raw.where("resource = 'videos'"), raw, "videos", at)  # replayed
    assert content(store) == want
