"""Versioned table store: versions, incomplete folders, NOT NULL, partitions."""

import datetime as dt
import os
import tempfile

import pytest

from chronoledger import schemas as S
from chronoledger.sources.tables import TableStore, add_column, conform, not_null_violations


def test_versions_and_partial_folder(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"))
    t = dt.datetime(2024, 1, 1)
    rows = [("r1", "src", None, t, None, "RUNNING", None)]
    assert store.publish("control", "ingestion_runs", spark.createDataFrame(rows, S.INGESTION_RUNS)) == 1
    rows2 = rows + [("r2", "src", "x", t, t, "SUCCESS", None)]
    assert store.publish("control", "ingestion_runs", spark.createDataFrame(rows2, S.INGESTION_RUNS)) == 2
    # a crashed writer leaves a folder without _SUCCESS: readers ignore it
    os.makedirs(os.path.join(store.path("control", "ingestion_runs"), "v=3"))
    assert store.versions("control", "ingestion_runs") == [1, 2]
    assert store.read("control", "ingestion_runs").count() == 2


def test_not_null_enforced_on_publish(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"))
    bad = spark.createDataFrame([(None, "r", dt.datetime(2024, 1, 1), 1, 1, 1)],
                                "video_id string, ingestion_id string, collected_at timestamp_ntz, "
                                "view_count bigint, like_count bigint, comment_count bigint")
    assert not_null_violations(bad, S.required_columns("video_snapshots")).collect()[0].violated == "video_id"
    with pytest.raises(Exception):
        store.publish("silver", "video_snapshots", bad)


def test_raw_partitioned_by_resource(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"))
    t = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([("r", "videos", "{}", "{}", t, 0), ("r", "channels", "{}", "{}", t, 0)],
                                S.API_RESPONSES)
    store.append("raw", "api_responses", raw)
    n = store.append("raw", "api_responses", raw)
    base = os.path.join(store.path("raw", "api_responses"), f"v={n}")
    part = os.path.join(base, next(p for p in os.listdir(base) if p.startswith("part=")))
    assert sorted(p for p in os.listdir(part) if p.startswith("resource=")) == ["resource=channels", "resource=videos"]
    back = store.read("raw", "api_responses")
    assert back.columns == S.API_RESPONSES.fieldNames()
    assert back.where("resource = 'videos'").count() == 2
    plan = back.where("resource = 'videos'")._jdf.queryExecution().executedPlan().toString()
    assert "resource" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_batch_appended_again_replaces_itself(spark):
    """A task that is stopped after its write and done again doubles no page; other batches stay."""
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"))
    t = dt.datetime(2024, 1, 1)

    def pages(run, n):
        return spark.createDataFrame([(run, "videos", "{}", f"{k}", t, k) for k in range(n)], S.API_RESPONSES)
    computed = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            computed.add(1)
            yield r
    store.append("raw", "api_responses", pages("r1", 3), batch="r1-videos")
    store.append("raw", "api_responses", pages("r2", 2), batch="r2-videos")
    again = spark.createDataFrame(pages("r1", 4).rdd.mapPartitions(counted), S.API_RESPONSES)
    store.append("raw", "api_responses", again, batch="r1-videos")
    assert computed.value == 4  # the batch is computed once
    assert sorted((r.ingestion_id, r.response_json) for r in store.read("raw", "api_responses").select("ingestion_id", "response_json").collect()) == [
        ("r1", "0"), ("r1", "1"), ("r1", "2"), ("r1", "3"), ("r2", "0"), ("r2", "1")]
    store.publish("raw", "api_responses", store.read("raw", "api_responses"))
    assert len(store.live("raw", "api_responses")) == 1 and store.read("raw", "api_responses").count() == 6


def test_parts_replaced_emptied_and_read_alone(spark):
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"), buckets=8)
    rows = spark.range(100).selectExpr("'run' || id % 4 AS ingestion_id", "'v' AS video_id", "'c' || id AS comment_id")
    store.publish("control", "ingestion_comments", rows)
    one = rows.where("ingestion_id = 'run1'")
    parts = store.parts("ingestion_comments", one)
    kept = store.read("control", "ingestion_comments", parts).where("ingestion_id <> 'run1'")
    before = store.read("control", "ingestion_comments")
    store.replace("control", "ingestion_comments", kept, parts)
    assert store.read("control", "ingestion_comments").where("ingestion_id = 'run1'").count() == 0
    assert store.read("control", "ingestion_comments").count() == 75 and before.count() == 100
    assert store.read("control", "ingestion_comments", version=1).count() == 100
    # a stopped writer's folder doesn't count, and the next version has a number of its own
    os.makedirs(os.path.join(store.path("control", "ingestion_comments"), "v=3", f"part={parts[0]}"))
    assert store.read("control", "ingestion_comments").count() == 75
    assert store.replace("control", "ingestion_comments", one, store.parts("ingestion_comments", one)) == 4
    feed = store.changes("control", "ingestion_comments", 2, 4)
    assert {r._change_type for r in feed.collect()} <= {"insert", "delete"} and feed.where("ingestion_id = 'run1'").count() == 25
    with pytest.raises(ValueError, match="8 buckets"):
        TableStore(spark, store.root, buckets=16)
    from chronoledger.sources.tables import Change
    with pytest.raises(ValueError, match="repeat a key"):
        store.apply("control", "ingestion_comments", Change(one.unionByName(one), lambda t, r: t, unique=("ingestion_id", "comment_id")))
    with pytest.raises(ValueError, match="merged by key"):
        store.append("silver", "videos", spark.createDataFrame([], S.VIDEOS))


def test_conform_and_add_column(spark):
    df = spark.createDataFrame([("r1", "x")], "ingestion_id string, status string")
    c = conform(df, S.INGESTION_RUNS)
    assert c.columns == S.INGESTION_RUNS.fieldNames()
    with pytest.raises(ValueError):
        conform(df.withColumn("bogus", df.status), S.INGESTION_RUNS)
    assert "channel_name" in add_column(df, "channel_name", "string").columns


def test_catalog_ddl_and_views(spark):
    from chronoledger.plans import serve
    from chronoledger.sources.tables import create_catalog_tables

    root = tempfile.mkdtemp(prefix="cl-cat-")
    names = create_catalog_tables(spark, root, database_prefix="t_")
    assert len(names) == 12 and "t_control.video_targets" in names
    cols = {r.col_name: r.comment for r in spark.sql("DESCRIBE t_control.ingestion_runs").collect()}
    assert cols["status"].startswith("RUNNING")
    # idempotent
    create_catalog_tables(spark, root, database_prefix="t_")
    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"))
    store.create_all()
    assert "control_video_targets" in store.register_views()
    tables = {t: store.read(layer, t) for (layer, t) in S.TABLES}
    assert serve.register_views(tables) == ["dashboard_ingestion_runs", "dashboard_video_targets",
                                            "dashboard_video_metrics", "dashboard_channel_metrics"]
    assert spark.sql("SELECT count(*) AS n FROM dashboard_video_targets").collect()[0].n == 0


def test_empty_batches_are_noops(spark):
    from chronoledger.operators import merge as M

    store = TableStore(spark, tempfile.mkdtemp(prefix="cl-tbl-"))
    store.create_all()
    before = sorted(os.listdir(store.path("raw", "api_responses")))
    store.append("raw", "api_responses", spark.createDataFrame([], S.API_RESPONSES))
    assert sorted(os.listdir(store.path("raw", "api_responses"))) == before
    t = spark.createDataFrame([("a", 1)], "k string, v bigint")
    empty = spark.createDataFrame([], "k string, v bigint")
    for strategy in ("broadcast", "shuffle"):
        assert [tuple(r) for r in M.upsert(t, empty, "k", strategy=strategy).collect()] == [("a", 1)]


def test_snapshot_projection(spark):
    from chronoledger.operators.snapshots import snapshot_rows

    cur = spark.createDataFrame([("k7Q", "a title", 420, 37, 5), ("", "no id", 3, 2, 1), (None, "none", 3, 2, 1), ("k7Q2", "gaps", None, None, 0)],
                                "video_id string, title string, view_count bigint, like_count bigint, comment_count bigint")
    rows = snapshot_rows(cur, "videos", "night-4", "2023-11-05 06:30:00").collect()
    at = dt.datetime(2023, 11, 5, 6, 30)
    assert sorted(tuple(r) for r in rows) == [("k7Q", "night-4", at, 420, 37, 5), ("k7Q2", "night-4", at, None, None, 0)]
