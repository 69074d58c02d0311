"""Physical-plan properties the scale design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from chronoledger.operators import merge as M
from chronoledger.operators.dedupe import latest_per_key
from chronoledger.operators.topn import bounded_per_group
from chronoledger.plans import registry as R


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_combines_before_shuffle(spark):
    # one hot key holds a third of the rows
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                  F.col("id").alias("v"))
    p = plan(latest_per_key(df, "k", ["v"]))
    assert "partial_max_by" in p
    assert p.index("Exchange") < p.index("partial_max_by")  # partial agg sits below the exchange
    got = {r.k: r.v for r in latest_per_key(df, "k", ["v"]).collect()}
    assert got[0] == 2997


def test_top_n_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    p = plan(bounded_per_group(df, "g", [F.col("o")], 3))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_broadcast_merge_does_not_shuffle_target(spark):
    t = spark.range(10000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    s = spark.createDataFrame([("5", 50), ("x", 1)], "k string, v bigint")
    out = M.upsert(t, s, "k", strategy="broadcast")
    p = plan(out)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert p.count("Exchange hashpartitioning") == 1  # of the matched keys, at most the source's
    assert sorted((r.k, r.v) for r in out.where("k in ('5', 'x')").collect()) == [("5", 50), ("x", 1)]


def test_trend_pushes_filters_and_has_no_cross_join(spark, sf):
    p = plan(R.QUERIES["video_trend"](spark, sf))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_merge_claim_broadcasts_bounded_claim(spark, sf):
    p = plan(R.QUERIES["merge_claim"](spark, sf))
    assert "TakeOrderedAndProject" in p  # the claim is a top-k, not a global sort


def test_filters_and_joins_on_the_key_pass_through_arg_max(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 AS k", "id AS v", "CAST(id AS STRING) AS s").write.parquet(f"{tmp_path}/t")
    df = latest_per_key(spark.read.parquet(f"{tmp_path}/t"), "k", ["v"])
    assert "EqualTo(k,5)" in plan(df.where("k = 5"))
    assert [(r.k, r.v) for r in df.where("k = 5").collect()] == [(5, 96)]
    other = spark.read.parquet(f"{tmp_path}/t").groupBy("k").count()
    p = plan(df.hint("merge").join(other, "k"))
    assert p.count("Exchange hashpartitioning(k#") == 2  # one for each aggregate, none for the join


def test_building_a_query_starts_no_job(spark, sf):
    tracker = spark.sparkContext.statusTracker()
    for name in ("apply_channels", "apply_comments", "apply_replies", "merge_upsert", "merge_composite_key", "finalize_targets", "video_trend",
                 "latest_videos", "run_channel_names", "replace_slice", "merge_finish_run"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        R.QUERIES[name](spark, sf)
        # reading a parquet footer for its schema is the one job that a read may start
        spark.sparkContext.setJobGroup("rest", "rest")
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        assert all(len(tracker.getJobInfo(j).stageIds) == 1 and tracker.getStageInfo(tracker.getJobInfo(j).stageIds[0]).numTasks == 1
                   for j in jobs), name
