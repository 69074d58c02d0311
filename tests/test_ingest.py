"""Two consecutive runs through the versioned table store."""

import datetime as dt
import json
import os
import tempfile

from chronoledger import schemas as S
from chronoledger.plans import ingest as IG
from chronoledger.sources.tables import TableStore, conform

RAW = S.API_RESPONSES


def page(run, resource, items, at):
    return (run, resource, json.dumps({"part": "snippet"}), json.dumps({"items": items}), at, 0)


def video(vid, ch, views):
    return {"id": vid, "snippet": {"channelId": ch, "title": f"T {vid}"}, "statistics": {"viewCount": str(views)}}


def raw_for(spark, run, at, views):
    rows = [
        page(run, "videos", [video("v1", "ch1", views), video("v2", "ch2", views + 1)], at),
        page(run, "channels", [{"id": "ch1", "snippet": {"title": "Channel One"},
                                "statistics": {"subscriberCount": "10"}}], at),
        page(run, "commentThreads", [{"id": "t1", "snippet": {"topLevelComment": {
            "id": "c1", "snippet": {"videoId": "v1", "textDisplay": "hi"}}}}], at),
        page(run, "comments", [{"id": "r1", "snippet": {"parentId": "c1", "videoId": "v1"}},
                               {"id": "r2", "snippet": {"parentId": "c1", "videoId": "v1"}}], at),
    ]
    return spark.createDataFrame(rows, RAW)


def test_two_runs(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-store-"))
    store.create_all()
    t0 = dt.datetime(2024, 1, 1)
    targets = spark.createDataFrame([(v, True, 1, 1, t0, t0) for v in ("v1", "v2", "v3")], S.VIDEO_TARGETS)
    store.publish("control", "video_targets", targets)
    names = [t for (_, t) in S.TABLES if t != "api_responses"]

    def load():
        return {t: store.read(next(l for (l, n) in S.TABLES if n == t), t) for t in names}

    tables, counts = IG.run_ingestion(load(), raw_for(spark, "run1", t0, 100), "run1", "2024-01-01 00:00:00",
                                      batch_size=10, max_replies_per_comment=1, store=store)
    st = {r.video_id: r for r in store.read("control", "video_processing_state").collect()}
    assert st["v1"].status == "SUCCESS" and st["v1"].attempt_count == 1
    assert st["v2"].status == "FAILED" and "fetch_channels" in st["v2"].error_message
    assert st["v3"].status == "NOT_FOUND"
    run = store.read("control", "ingestion_runs").collect()[0]
    assert (run.status, run.channel_name) == ("PARTIAL_SUCCESS", "Channel One") and run.ended_at is not None
    assert store.read("silver", "replies").count() == 1  # bounded to one reply per comment
    assert store.read("control", "ingestion_comments").count() == 0  # hand-off cleared at finalise
    step_rows = {(r.step, r.n_rows) for r in counts.collect()}
    # every step ran: claim, the four fetches, finalise
    assert {s for s, _ in step_rows} >= {"claim", "fetch_videos", "fetch_channels", "fetch_comments",
                                         "fetch_replies", "finalize"}
    assert ("fetch_videos", 2) in step_rows and ("claim", 3) in step_rows

    # second run two hours later: every target is due again (1-hour interval)
    t1 = "2024-01-01 02:00:00"
    IG.run_ingestion(load(), raw_for(spark, "run2", dt.datetime(2024, 1, 1, 2), 500), "run2", t1,
                     batch_size=10, store=store)
    snaps = store.read("silver", "video_snapshots")
    assert snaps.count() == 4  # two per run: snapshots accumulate
    cur = {r.video_id: r.view_count for r in store.read("silver", "videos").collect()}
    assert cur == {"v1": 500, "v2": 501}  # current state overwritten
    st = {r.video_id: r for r in store.read("control", "video_processing_state").collect()}
    assert st["v1"].attempt_count == 2 and st["v1"].last_ingestion_id == "run2"
    assert len(store.versions("control", "video_processing_state")) >= 4


def _store(spark, videos):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-store-"))
    store.create_all()
    t0 = dt.datetime(2024, 1, 1)
    store.publish("control", "video_targets", spark.createDataFrame([(v, True, 1, 1, t0, t0) for v in videos], S.VIDEO_TARGETS))

    def load():
        return {t: store.read(layer, t) for (layer, t) in S.TABLES if t != "api_responses"}
    return store, load


def _owned(spark, tables, run):
    from chronoledger.operators.queue import owned_targets
    return owned_targets(tables["video_targets"], tables["video_processing_state"], spark.createDataFrame([(run,)], "ingestion_id string"))


def test_finalise_is_safe_to_repeat(spark, monkeypatch):
    """Stopped after any of its publishes and started again, it closes run and targets."""
    at = "2024-01-01 00:00:00"
    for stop_after in ("ingestion_comments", "ingestion_runs", "video_processing_state"):
        store, load = _store(spark, ("v1", "v2", "v3"))
        real = TableStore.apply
        armed = []

        def apply(self, layer, table, change):
            n = real(self, layer, table, change)
            if armed and table == stop_after:
                raise RuntimeError("stopped")
            return n
        monkeypatch.setattr(TableStore, "apply", apply)
        original = IG.finalize

        def arm(*a, **kw):
            armed.append(1)
            return original(*a, **kw)
        monkeypatch.setattr(IG, "finalize", arm)
        try:
            IG.run_ingestion(load(), raw_for(spark, "run1", dt.datetime(2024, 1, 1), 100), "run1", at, batch_size=10, store=store)
            raise AssertionError("it was not stopped")
        except RuntimeError:
            pass
        monkeypatch.setattr(IG, "finalize", original)
        monkeypatch.setattr(TableStore, "apply", real)
        tables = load()
        new, _ = IG.finalize(tables, at, _owned(spark, tables, "run1"))
        IG._cut(new, set(new[IG.CHANGES]), store)
        run = store.read("control", "ingestion_runs").collect()[0]
        assert run.status == "PARTIAL_SUCCESS" and run.ended_at is not None, stop_after
        assert {r.video_id: r.status for r in store.read("control", "video_processing_state").collect()} == {
            "v1": "SUCCESS", "v2": "FAILED", "v3": "NOT_FOUND"}
        assert store.read("control", "ingestion_comments").count() == 0


def test_failed_requests_fail_their_videos(spark):
    store, load = _store(spark, ("v1", "v2"))
    t0 = dt.datetime(2024, 1, 1)
    bad = spark.createDataFrame([("run1", "v1", t0, 1, 500, "down")], IG.FAILURE)
    off = spark.createDataFrame([("run1", "v1", t0, 1, 403, '{"error":{"reason":"commentsDisabled"}}')], IG.FAILURE)
    IG.run_ingestion(load(), raw_for(spark, "run1", t0, 5), "run1", "2024-01-01 00:00:00", 10, store=store, comment_failures=off, reply_failures=off)
    steps = {(r.video_id, r.step): r for r in store.read("control", "ingestion_step_outcomes").collect()}
    assert steps["v1", "fetch_comments"].status == "SUCCESS"
    assert steps["v1", "fetch_replies"].status == "FAILED" and steps["v1", "fetch_replies"].error_message.endswith('{"error":{"reason":"commentsDisabled"}}')
    IG.run_ingestion(load(), raw_for(spark, "run2", t0, 5).where("resource <> 'commentThreads'"), "run2", "2024-01-01 03:00:00", 10, store=store,
                     comment_failures=bad.selectExpr("'run2' AS ingestion_id", "video_id", "ts", "attempt_id", "status_code", "body"))
    steps = {(r.video_id, r.step): r for r in store.read("control", "ingestion_step_outcomes").where("ingestion_id = 'run2'").collect()}
    assert steps["v1", "fetch_comments"].status == "FAILED" and steps["v1", "fetch_comments"].error_message.endswith("500: down")


def test_caps_count_children_once_and_in_page_order(spark):
    t0 = dt.datetime(2024, 1, 1)

    def thread(c):
        return {"id": f"t{c}", "snippet": {"topLevelComment": {"id": f"c{c:02d}", "snippet": {"videoId": "v1"}}}}

    def pages(at, *lists):
        return [("run1", "commentThreads", "{}", json.dumps({"items": [thread(c) for c in cs]}), at, p) for p, cs in enumerate(lists)]
    later = t0 + dt.timedelta(minutes=5)
    for rows, cap, want in (
            (pages(t0, [0, 1, 2]) + pages(later, [0, 1, 2, 3, 4, 5]), 5, [0, 1, 2, 3, 4]),
            (pages(t0, [0, 1, 2], [3, 4, 5]), 4, [0, 1, 2, 3]),
            (pages(t0, [0, 1], [2, 3]) + pages(t0, [0, 1], [2, 3]), 3, [0, 1, 2])):
        store, load = _store(spark, ("v1",))
        raw = raw_for(spark, "run1", t0, 1).where("resource IN ('videos', 'channels')").unionByName(spark.createDataFrame(rows, RAW))
        IG.run_ingestion(load(), raw, "run1", "2024-01-01 00:00:00", 10, max_comments_per_video=cap, store=store)
        assert sorted(r.comment_id for r in store.read("silver", "comments").collect()) == [f"c{c:02d}" for c in want]


def test_nothing_due_writes_no_more(spark):
    store, load = _store(spark, ())
    before = {t: store.versions(layer, t) for (layer, t) in S.TABLES}
    IG.run_ingestion(load(), raw_for(spark, "run1", dt.datetime(2024, 1, 1), 1), "run1", "2024-01-01 00:00:00", 10, store=store)
    after = {t: store.versions(layer, t) for (layer, t) in S.TABLES}
    assert {t for t in before if before[t] != after[t]} == {"ingestion_runs"}
    assert store.read("control", "ingestion_runs").collect()[0].status == "SUCCESS"


def test_nothing_due_closes_run(spark):
    t0 = dt.datetime(2024, 1, 1)
    empty = {t: spark.createDataFrame([], sch) for (_, t), sch in S.TABLES.items()}
    tables, _ = IG.claim(empty, "runX", "2024-01-01 00:00:00", 5)
    r = tables["ingestion_runs"].collect()[0]
    assert r.status == "SUCCESS" and r.ended_at is not None


def test_a_small_run_writes_only_the_parts_it_touches(spark):
    """A run of two videos on a table of 3,000 leaves all other parts as they are."""
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-store-"), buckets=32)
    store.create_all()
    t0 = dt.datetime(2024, 1, 1)
    targets = [(v, True, 1, 1, t0, t0) for v in ("v1", "v2")] + [(f"old{i}", False, 1, 1, t0, t0) for i in range(3000)]
    store.publish("control", "video_targets", spark.createDataFrame(targets, S.VIDEO_TARGETS))
    store.publish("silver", "videos", conform(spark.range(3000).selectExpr("concat('old', id) AS video_id", "'x' AS title", "TIMESTAMP_NTZ'2023-01-01' AS ingested_at"), S.VIDEOS))
    old = spark.range(3000).selectExpr("concat('old', id) AS video_id", "'SUCCESS' AS status", "1 AS attempt_count")
    store.publish("control", "video_processing_state", conform(old, S.VIDEO_PROCESSING_STATE))
    before = {t: store.live(layer, t) for (layer, t) in S.TABLES}

    def load():
        return {t: store.read(layer, t) for (layer, t) in S.TABLES if t != "api_responses"}
    IG.run_ingestion(load(), raw_for(spark, "run1", t0, 7), "run1", "2024-01-01 00:00:00", 10, store=store)
    for layer, table, most in (("silver", "videos", 2), ("control", "video_processing_state", 2), ("control", "ingestion_step_outcomes", 1)):
        after = store.live(layer, table)
        assert 0 < sum(after[p] != before[table].get(p) for p in after) <= most, table
    assert len(before["videos"]) == 32
    newest = store.versions("silver", "videos")[-1]
    base = os.path.join(store.path("silver", "videos"), f"v={newest}")
    files = [f for _, _, names in os.walk(base) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2
    assert store.read("silver", "videos").count() == 3002 and store.read("control", "video_processing_state").count() == 3002
    feed = store.changes("silver", "videos", store.versions("silver", "videos")[-2], newest).collect()
    assert sorted((r.video_id, r._change_type) for r in feed) == [("v1", "insert"), ("v2", "insert")]


def test_counts_are_taken_before_caps_and_copies(spark):
    store, load = _store(spark, ("v1", "v2"))
    t0 = dt.datetime(2024, 1, 1)
    raw = raw_for(spark, "run1", t0, 5)
    raw = raw.unionByName(raw.where("resource = 'comments'"))  # a page that was stored again
    _, counts = IG.run_ingestion(load(), raw, "run1", "2024-01-01 00:00:00", 10, max_replies_per_comment=1, store=store)
    assert {(r.step, r.n_rows) for r in counts.collect()} >= {("fetch_comments", 1), ("fetch_replies", 4)}
    assert store.read("silver", "replies").count() == 1


def test_a_run_done_again_changes_nothing(spark):
    store, load = _store(spark, ("v1", "v2", "v3"))
    t0, at = dt.datetime(2024, 1, 1), "2024-01-01 00:00:00"
    raw = raw_for(spark, "run1", t0, 5)
    tables, _ = IG.claim(load(), "run1", at, 10)
    IG._cut(tables, set(tables[IG.CHANGES]), store)
    owned = _owned(spark, load(), "run1")
    seen = []
    for _ in range(2):
        new, _ = IG.apply_videos(load(), raw, at, owned)
        IG._cut(new, set(new[IG.CHANGES]), store)
        seen.append({t: sorted(map(str, store.read(layer, t).collect())) for (layer, t) in S.TABLES})
    assert seen[0] == seen[1] and len(seen[0]["video_snapshots"]) == 2
