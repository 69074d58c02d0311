"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and run ``BENCH_WARMUPS`` (2) times to warm up, then timed ``BENCH_REPS``
times into a ``noop`` sink (full execution, no collect); the median is
reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from chronoledger.operators import dedupe as D  # noqa: E402
from chronoledger.operators import merge as M  # noqa: E402
from chronoledger.plans import registry as R  # noqa: E402
from chronoledger.plans import serve  # noqa: E402
from chronoledger.session import build_session  # noqa: E402
from chronoledger.sources import standins as SI  # noqa: E402
from chronoledger.sources.tables import load  # noqa: E402

HEADLINE = [
    "video_trend", "channel_trend", "latest_videos", "range_join_history", "views_total_by_day",
    "claim_due", "merge_claim", "merge_upsert", "merge_upsert_shuffle", "merge_insert_only",
    "merge_composite_key", "change_feed", "dedupe_latest", "finalize_targets", "merge_finish_target",
    "normalize_videos", "raw_flatten", "classify_errors", "apply_videos", "apply_comments",
]


def repeated_snapshots(spark, d, times: int):
    """A history repeated ``times`` times (copies a few seconds apart): the
    same entities, ``times`` x the observations, as ``times`` separate inputs
    (as further files of the table would be)."""
    snaps = SI.video_snapshots(spark, d)
    many = None
    for rep in range(times):
        copy = snaps.selectExpr(
            "video_id", f"concat(ingestion_id, '-{rep}') AS ingestion_id",
            f"collected_at - INTERVAL {rep} SECONDS AS collected_at",
            "view_count", "like_count", "comment_count")
        many = copy if many is None else many.unionByName(copy)
    return many


def video_trend_repeated(times: int):
    """The trend over a repeated history, from the snapshots."""
    def run(spark, d):
        many = repeated_snapshots(spark, d, times)
        return serve.video_trend(SI.targets(spark, d), many, SI.videos(spark, d), R.TREND_AS_OF, R.TREND_DAYS)
    return run


def video_trend_10x_seeded():
    """The trend over the same tenfold history, read from its stored rollup
    and seeds (written once, before anything is timed)."""
    import tempfile

    from chronoledger.operators.timeseries import daily_rollup, next_seed, seed_day
    folder, name = tempfile.mkdtemp(prefix="bench-rollup-"), "collected_date"

    def run(spark, d):
        if not os.path.exists(f"{folder}/seeds"):
            rollup = daily_rollup(repeated_snapshots(spark, d, 10), "video_id", "collected_at", ["ingestion_id"], serve.VIDEO_METRICS, name=name)
            rollup.repartition(name).write.partitionBy(name).parquet(f"{folder}/rollup")
            rollup = spark.read.parquet(f"{folder}/rollup")
            day = seed_day(R.TREND_AS_OF, R.TREND_DAYS)
            next_seed(None, rollup, "video_id", None, day, name).write.partitionBy("seed_day").parquet(f"{folder}/seeds")
        rollup, seeds = spark.read.parquet(f"{folder}/rollup"), spark.read.parquet(f"{folder}/seeds")
        return serve.video_trend_from_seed(SI.targets(spark, d), rollup, seeds, SI.videos(spark, d), R.TREND_AS_OF, R.TREND_DAYS)
    return run


def merge_sweep(percent: int):
    """An upsert into lineitem of ``percent`` per cent of its keys."""
    def run(spark, d):
        keys = ["l_orderkey", "l_linenumber"]
        rows = D.latest_per_key(load(spark, d, "lineitem").select(*keys, "l_quantity"), keys, ["l_quantity"])
        changed = rows.where(F.pmod(F.xxhash64(*keys), F.lit(100)) < percent).withColumn("l_quantity", F.col("l_quantity") + 1)
        return M.upsert(rows, changed, keys)
    return run


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "64m"})
    queries = {name: R.QUERIES[name] for name in HEADLINE}
    queries["video_trend_10x"] = video_trend_repeated(10)
    queries["video_trend_10x_seeded"] = video_trend_10x_seeded()
    for percent in (1, 10, 100):
        queries[f"merge_sweep_{percent}"] = merge_sweep(percent)
    if only:
        queries = {k: v for k, v in queries.items() if k in only}
    # touch the inputs once so file listing / JIT warm-up is not charged to the first query
    for t in ("events", "customer", "orders", "lineitem", "conversations"):
        load(spark, sf_dir, t).count()
    results = {}
    # process-level warm-up: every query once, so the first timed query does
    # not carry the JVM's cold start (class loading, JIT) for all the others
    for fn in queries.values():
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    warmups = int(os.environ.get("BENCH_WARMUPS", "2"))
    for name, fn in queries.items():
        for _ in range(warmups):
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times = []
        for _ in range(reps):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        print(f"# {name}: {results[name]}s {['%.2f' % x for x in times]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_median_query_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
