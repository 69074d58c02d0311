"""LOCF trend against a brute-force statement of the served SQL."""

import datetime as dt
import random

from chronoledger.operators.timeseries import last_at_or_before, locf

SCHEMA = "video_id string, ingestion_id string, collected_at timestamp_ntz, view_count bigint"


def brute(rows, entities, as_of, days, keep_null_days):
    end = dt.date.fromisoformat(as_of)
    out = set()
    for e in entities:
        for i in range(days):
            day = end - dt.timedelta(days=days - 1 - i)
            cands = [r for r in rows if r[0] == e and r[2] < dt.datetime.combine(day + dt.timedelta(days=1), dt.time())]
            if not cands:
                if keep_null_days:
                    out.add((e, day, None))
                continue
            best = max(cands, key=lambda r: (r[2], r[1]))
            if best[3] is None and not keep_null_days:
                continue
            out.add((e, day, best[3]))
    return out


def test_locf_edges(spark):
    T = dt.datetime
    rows = [
        ("v1", "r1", T(2024, 1, 1, 5), 10),      # before the window: seeds day 1
        ("v1", "r2", T(2024, 1, 12, 0), 20),     # exactly midnight: belongs to the 12th
        ("v1", "r3", T(2024, 1, 12, 9), None),   # latest of the 12th is NULL: day dropped
        ("v1", "r4", T(2024, 1, 14, 9), 40),
        ("v2", "r5", T(2024, 1, 13, 1), 7),
        ("v2", "r6", T(2024, 1, 13, 1), 8),      # same instant: tie broken by run id
        ("v1", "r7", T(2024, 1, 16, 0), 99),     # after as_of: ignored
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.video_id, r.day, r.view_count) for r in
           locf(df, "video_id", "collected_at", ["ingestion_id"], ["view_count"], "2024-01-15", 5,
                require_not_null="view_count").collect()}
    assert got == brute(rows, ["v1", "v2", "v3"], "2024-01-15", 5, False)
    assert ("v1", dt.date(2024, 1, 11), 10) in got and ("v1", dt.date(2024, 1, 12), None) not in got
    ents = spark.createDataFrame([("v1",), ("v2",), ("v3",)], "video_id string")
    full = {(r.video_id, r.day, r.view_count) for r in
            last_at_or_before(ents, df, "video_id", "collected_at", ["ingestion_id"], ["view_count"],
                              "2024-01-15", 5).collect()}
    assert full == brute(rows, ["v1", "v2", "v3"], "2024-01-15", 5, True)


def test_locf_random(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        rows.append((f"v{rnd.randint(0, 6)}", f"r{i:04d}",
                     dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40)),
                     None if rnd.random() < 0.15 else rnd.randint(0, 1000)))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.video_id, r.day, r.view_count) for r in
           locf(df, "video_id", "collected_at", ["ingestion_id"], ["view_count"], "2024-02-05", 20,
                require_not_null="view_count").collect()}
    assert got == brute(rows, [f"v{i}" for i in range(7)], "2024-02-05", 20, False)


def test_total_by_day_from_spans(spark):
    from chronoledger.operators.timeseries import locf_spans, total_by_day_from_spans

    rnd = random.Random(11)
    rows = []
    for i in range(200):
        rows.append((f"v{rnd.randint(0, 9)}", f"r{i:04d}",
                     dt.datetime(2024, 1, 10) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 25)),
                     None if rnd.random() < 0.2 else rnd.randint(0, 1000)))
    df = spark.createDataFrame(rows, SCHEMA)
    spans = locf_spans(df, "video_id", "collected_at", ["ingestion_id"], ["view_count"], "2024-02-10", 40,
                       require_not_null="view_count")
    got = {(r.day, r.total) for r in total_by_day_from_spans(spans, "view_count", "total").collect()}
    per_day = {}
    for e, day, v in brute(rows, [f"v{i}" for i in range(10)], "2024-02-10", 40, False):
        per_day[day] = per_day.get(day, 0) + v
    assert got == set(per_day.items())
    # the window starts before any observation: early days are absent, not zero
    assert min(d for d, _ in got) >= dt.date(2024, 1, 10)


def test_trend_from_maintained_rollup_equals_direct(spark):
    from chronoledger.operators.timeseries import (daily_rollup, expand_spans, locf_spans,
                                                   locf_spans_from_rollup, merge_rollups)

    rnd = random.Random(5)
    rows = [(f"v{rnd.randint(0, 5)}", f"r{i:04d}",
             dt.datetime(2023, 12, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 70)),
             None if rnd.random() < 0.15 else rnd.randint(0, 1000)) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    args = ("video_id", "collected_at", ["ingestion_id"], ["view_count"])
    direct = expand_spans(locf_spans(df, *args, "2024-01-31", 20, require_not_null="view_count"),
                          ["view_count"])
    # rollup maintained in two increments (history, then newer snapshots)
    old = df.where("collected_at < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    new = df.where("collected_at >= TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    roll = merge_rollups(daily_rollup(old, *args), daily_rollup(new, *args), "video_id")
    via = expand_spans(locf_spans_from_rollup(roll, "video_id", "2024-01-31", 20,
                                              require_not_null="view_count"), ["view_count"])
    got = {(r.video_id, r.day, r.view_count) for r in via.collect()}
    assert got == {(r.video_id, r.day, r.view_count) for r in direct.collect()}
    assert got == brute(rows, [f"v{i}" for i in range(6)], "2024-01-31", 20, False)


def test_trend_from_seed_reads_no_history(spark, tmp_path):
    """Same rows as from all snapshots; both stored tables are pruned to the window's first month on."""
    from chronoledger.operators.timeseries import daily_rollup, next_seed, seed_day
    from chronoledger.plans import serve

    obs = spark.range(4000).selectExpr(
        "concat('v', id % 37) AS video_id", "concat('r', id) AS ingestion_id",
        "TIMESTAMP_NTZ'2023-01-01' + make_dt_interval(CAST(id * 7919 % 400 AS INT), CAST(id % 24 AS INT)) AS collected_at",
        "IF(id % 11 = 0, NULL, id) AS view_count", "id AS like_count", "id AS comment_count")
    obs = obs.where("NOT (video_id = 'v5' AND collected_at >= '2023-03-01')")  # one that is seeded from long before
    targets = spark.range(37).selectExpr("concat('v', id) AS video_id", "id % 5 <> 0 OR id = 5 AS is_active")
    videos = targets.selectExpr("video_id", "video_id AS title", "'ch' AS channel_title")
    as_of, days, name = "2024-01-20", 40, "collected_date"
    rollup = daily_rollup(obs, "video_id", "collected_at", ["ingestion_id"], serve.VIDEO_METRICS, name=name)
    rollup.write.partitionBy(name).parquet(f"{tmp_path}/rollup")
    rollup = spark.read.parquet(f"{tmp_path}/rollup")
    months = [dt.date(2023, m, 1) for m in range(2, 13)]
    for since, until in zip([None, *months], months):
        seed = next_seed(None if since is None else spark.read.parquet(f"{tmp_path}/seeds"), rollup, "video_id", since, until, name)
        seed.checkpoint().write.mode("append").partitionBy("seed_day").parquet(f"{tmp_path}/seeds")
    assert seed_day(as_of, days) == dt.date(2023, 12, 1)
    got = serve.video_trend_from_seed(targets, rollup, spark.read.parquet(f"{tmp_path}/seeds"), videos, as_of, days)
    want = serve.video_trend(targets, obs, videos, as_of, days)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.where("video_id = 'v5'").count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
    assert any("collected_date" in f and ">= 2023-12-01" in f for f in filters) and any("seed_day" in f and "= 2023-12-01" in f for f in filters)


def test_trends_are_served_by_day(spark, sf):
    from chronoledger.plans import registry as R

    rows = [(r.collected_date, r.video_id) for r in R.QUERIES["video_trend_by_day"](spark, sf).collect()]
    assert rows == sorted(rows) and len(rows) > 100
