"""Run-level steps: claim -> videos -> channels -> comments -> replies -> finalise.

Each step is a function ``(tables, raw, ...) -> (tables, counts)`` over
*all* runs it is given at once: ``tables`` maps table names to DataFrames
(current versions) and the returned dict holds the next versions of the
tables the step changed. Fetched data arrives as stored API pages in the raw
table (``raw.api_responses``); steps reprocess those pages instead of calling
an API. ``counts`` is a small DataFrame (ingestion_id, step, n_rows) of rows
returned per run and step, before deduplication and caps.

Besides the next versions, a step returns the changes that make them
(``CHANGES``: the rows to merge, and the merge). ``run_ingestion`` chains the
steps. With a ``TableStore`` each step's changes are applied to the parts of
the tables that they touch, and to no others (which also cuts the lineage);
otherwise changed tables are checkpointed to the shared
``spark.checkpoint.dir`` when ``cut_lineage`` is set.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.operators import merge as M
from chronoledger.operators import normalize as N
from chronoledger.operators import outcomes as OC
from chronoledger.operators import queue as Q
from chronoledger.operators.dedupe import latest_per_key
from chronoledger.operators.snapshots import snapshot_rows
from chronoledger.operators.topn import bounded_per_group
from chronoledger.sources.tables import RECEIVED, Change

OUTCOME_KEYS = ["ingestion_id", "video_id", "step"]
ITEM_ORDER = ["received_at", "ingestion_id", "page_no", "item_pos"]
PAGE_ORDER = ["received_at", "page_no", "item_pos"]
FAILURE = "ingestion_id string, video_id string, ts timestamp_ntz, attempt_id bigint, status_code int, body string"
# The state says which targets a run still owns, so it is published last:
# whatever was stopped before it is done again by the next finalise.
PUBLISH_LAST = ["ingestion_comments", "ingestion_runs", "video_processing_state"]


def _ts(v):
    return v if hasattr(v, "_jc") else F.lit(str(v)).cast("timestamp_ntz")


def _runs_of(df: DataFrame) -> DataFrame:
    """DISTINCT run ids, for semi joins that filter the raw table."""
    return df.select("ingestion_id").distinct()


def _first_items(items: DataFrame, parents: list[str], limit: int) -> DataFrame:
    """One row for each child of a (run, parent), with the values of its
    latest fetch at the place of its first, and of these the first ``limit``
    in API order (0 = all). Pages that a retried task stored again repeat
    children; a cap over the stored rows would count the copies."""
    keys = [*parents, "comment_id"]
    others = [c for c in items.columns if c not in keys]
    first = F.min(F.struct(*PAGE_ORDER)).alias("__first")
    last = F.max_by(F.struct(*others), F.struct(*PAGE_ORDER)).alias("__last")
    once = items.groupBy(*keys).agg(first, last).select(*keys, "__first", "__last.*")
    return bounded_per_group(once, parents, [F.col("__first"), F.col("comment_id")], limit).drop("__first")


CHANGES = "__changes__"


class _Next(dict):
    """Tables after a step: those that changed are merged when they are asked
    for (a store applies the changes themselves)."""

    def __init__(self, tables: dict, changes: dict):
        super().__init__({k: tables[k] for k in tables if k != CHANGES})
        self[CHANGES] = changes
        self._waiting = set(changes)

    def __getitem__(self, name):
        if name in self._waiting:
            self._waiting.discard(name)
            change = self[CHANGES][name]
            self[name] = change.merge(super().__getitem__(name), change.rows)
        return super().__getitem__(name)


def _changed(tables: dict, **changes: Change) -> dict:
    """The next versions of the tables that ``changes`` change, and the changes."""
    return _Next(tables, changes)


# Step that fetches each stored resource.
RESOURCE_STEP = {"videos": "fetch_videos", "channels": "fetch_channels", "commentThreads": "fetch_comments",
                 "comments": "fetch_replies", "playlistItems": "list_uploads"}


def returned_counts(raw: DataFrame) -> DataFrame:
    """Items returned per run and step, before any deduplication (every
    stored page counts, repeats included)."""
    step = F.create_map(*[x for kv in RESOURCE_STEP.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return (N.raw_flatten(raw).groupBy("ingestion_id", "resource").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("ingestion_id", step[F.col("resource")].alias("step"), "n_rows"))


def record_outcomes(outcomes: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert step outcomes on (run, video, step): a rerun replaces its result."""
    return M.merge(outcomes, new.select(*[f.name for f in S.INGESTION_STEP_OUTCOMES.fields]), OUTCOME_KEYS,
                   update={"status": "s.status", "completed_at": "s.completed_at",
                           "error_message": "s.error_message"}, insert="*")


def _counts(items: DataFrame, step: str) -> DataFrame:
    return items.groupBy("ingestion_id").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "ingestion_id", F.lit(step).alias("step"), "n_rows")


def upsert_newer(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Upsert in which a row from a page received earlier does not replace
    one from a later page. A target without receive times takes every row."""
    if RECEIVED not in target.columns:
        return M.upsert(target, rows.drop(RECEIVED), key)
    return M.upsert(target, rows, key, matched_condition=f"t.{RECEIVED} IS NULL OR s.{RECEIVED} >= t.{RECEIVED}")


def _latest(items: DataFrame, table: str, key: str, as_of) -> Change:
    """The latest row of each entity in ``items``, to be upserted into ``table``."""
    cols = [f.name for f in S.schema(table).fields if f.name != "ingested_at"]
    rows = latest_per_key(items, key, ITEM_ORDER).select(*cols, _ts(as_of).alias("ingested_at"), F.col("received_at").alias(RECEIVED))
    return Change(rows, lambda t, r: upsert_newer(t, r, key), unique=(key,))


def _snapshots(items: DataFrame, entity: str, key: str, as_of) -> Change:
    """One snapshot for each entity and run of ``items``; those that are there stay."""
    per_run = latest_per_key(items, [key, "ingestion_id"], ITEM_ORDER)
    rows = snapshot_rows(per_run, entity, F.col("ingestion_id"), as_of)
    return Change(rows, lambda t, r: t.unionByName(M.rows_to_insert(t, r, [key, "ingestion_id"])), unique=(key, "ingestion_id"))


def claim(tables: dict, ingestion_id: str, as_of, batch_size: int = 20) -> tuple[dict, DataFrame]:
    """Open a run and claim the next due targets for it. A run with nothing
    due is closed as SUCCESS immediately."""
    spark = tables["video_targets"].sparkSession
    due = Q.claim_due(tables["video_targets"], tables["video_processing_state"], as_of, batch_size)
    # at most batch_size rows: read once, so all that follows has the same batch
    rows = [tuple(r) for r in due.collect()]
    claimed = spark.createDataFrame(rows, due.schema)
    run = spark.range(1).select(F.lit(ingestion_id).alias("ingestion_id"))
    done = run.select("ingestion_id", F.lit(S.RUN_SUCCESS).alias("status"), F.lit(None).cast("string").alias("error_message"),
                      F.lit(None).cast("string").alias("channel_name"))

    def opened(runs: DataFrame, new: DataFrame) -> DataFrame:
        # a claim that is done again finds its run open
        runs = M.insert_only(runs, new, "ingestion_id", strategy="broadcast")
        return runs if rows else Q.finish_runs_merge(runs, done, as_of, strategy="broadcast")
    changes = {"ingestion_runs": Change(Q.open_runs(spark, run, as_of), opened)}
    if rows:
        changes["video_processing_state"] = Change(claimed, lambda t, c: Q.claim_merge(t, c, ingestion_id, as_of))
    return _changed(tables, **changes), spark.createDataFrame([(ingestion_id, "claim", len(rows))], "ingestion_id string, step string, n_rows long")


def apply_videos(tables: dict, raw: DataFrame, as_of, owned: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """Video step over stored pages: upsert current videos, insert one
    snapshot per (video, run), record SUCCESS / NOT_FOUND per owned target."""
    if owned is None:
        owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"])
    pages = raw.where(F.col("resource") == "videos").join(_runs_of(owned), "ingestion_id", "left_semi")
    items = N.normalize_videos(pages)
    outs = OC.found_outcomes(owned, items, "video_id", "fetch_videos", S.ST_NOT_FOUND,
                             S.MSG_VIDEO_NOT_FOUND, as_of)
    out = _changed(tables, videos=_latest(items, "videos", "video_id", as_of),
                   video_snapshots=_snapshots(items, "videos", "video_id", as_of),
                   ingestion_step_outcomes=Change(outs, record_outcomes, unique=tuple(OUTCOME_KEYS)))
    return out, _counts(items, "fetch_videos")


def apply_channels(tables: dict, raw: DataFrame, as_of, owned: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """Channel step: channels of the videos fetched successfully in the same
    run; upsert channels, snapshot them, record per-video outcomes."""
    if owned is None:
        owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"])
    ok = OC.succeeded_entities(owned, tables["ingestion_step_outcomes"], "fetch_videos")
    vc = OC.parent_lookup(ok, tables["videos"])
    pages = raw.where(F.col("resource") == "channels").join(_runs_of(vc), "ingestion_id", "left_semi")
    items = N.normalize_channels(pages)
    outs = OC.parent_outcomes(vc, items.select("ingestion_id", "channel_id"), as_of)
    out = _changed(tables, channels=_latest(items, "channels", "channel_id", as_of),
                   channel_snapshots=_snapshots(items, "channels", "channel_id", as_of),
                   ingestion_step_outcomes=Change(outs, record_outcomes, unique=tuple(OUTCOME_KEYS)))
    return out, _counts(items, "fetch_channels")


def apply_comments(tables: dict, raw: DataFrame, as_of, owned: DataFrame | None = None,
                   max_comments_per_video: int = 0, failures: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """Comment step: top-level comments of successfully fetched videos,
    bounded per video (0 = all) in API order; upsert comments, replace each
    run's hand-off slice, record per-video outcomes (``failures``: failed
    requests per (ingestion_id, video_id); COMMENTS_DISABLED succeeds)."""
    if owned is None:
        owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"])
    ok = OC.succeeded_entities(owned, tables["ingestion_step_outcomes"], "fetch_videos").select(
        "ingestion_id", "video_id")
    pages = raw.where(F.col("resource") == "commentThreads").join(_runs_of(ok), "ingestion_id", "left_semi")
    returned = N.normalize_comments(pages).join(ok, ["ingestion_id", "video_id"], "left_semi")
    items = _first_items(returned, ["ingestion_id", "video_id"], max_comments_per_video)
    handoff = Change(items.select("ingestion_id", "video_id", "comment_id"), lambda t, r: M.replace_slice(
        t, "ingestion_id", ok, r, required=["video_id", "comment_id"], dedupe_keys=["ingestion_id", "comment_id"]), keys=ok)
    if failures is None:
        failures = ok.sparkSession.createDataFrame([], FAILURE)
    res = OC.comment_outcomes(ok, failures, ["ingestion_id", "video_id"])
    outs = res.select("ingestion_id", "video_id", F.lit("fetch_comments").alias("step"), "status",
                      _ts(as_of).alias("completed_at"), "error_message")
    out = _changed(tables, comments=_latest(items, "comments", "comment_id", as_of), ingestion_comments=handoff,
                   ingestion_step_outcomes=Change(outs, record_outcomes, unique=tuple(OUTCOME_KEYS)))
    return out, _counts(returned, "fetch_comments")


def apply_replies(tables: dict, raw: DataFrame, as_of, owned: DataFrame | None = None,
                  max_replies_per_comment: int = 0,
                  failures: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """Reply step: replies to the comments staged by the *same* run for
    videos whose comment step succeeded, bounded per comment (0 = all)."""
    if owned is None:
        owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"])
    parents = OC.children_by_parent(tables["ingestion_comments"], tables["ingestion_step_outcomes"]).join(
        owned.select("ingestion_id", "video_id"), ["ingestion_id", "video_id"], "left_semi")
    videos = parents.select("ingestion_id", "video_id").distinct()
    staged = parents.where(F.col("comment_id").isNotNull()).select(
        "ingestion_id", F.col("comment_id").alias("parent_id"))
    pages = raw.where(F.col("resource") == "comments").join(_runs_of(videos), "ingestion_id", "left_semi")
    returned = N.normalize_replies(pages).join(staged, ["ingestion_id", "parent_id"], "left_semi")
    items = _first_items(returned, ["ingestion_id", "parent_id"], max_replies_per_comment)
    if failures is None:
        failures = videos.sparkSession.createDataFrame([], FAILURE)
    res = OC.comment_outcomes(videos, failures, ["ingestion_id", "video_id"])
    # comments-disabled does not apply to replies: any error fails the video
    status = F.when(F.col("category").isNull(), S.ST_SUCCESS).otherwise(S.ST_FAILED)
    err = F.when(F.col("category").isNotNull(), F.col("message"))
    outs = res.select("ingestion_id", "video_id", F.lit("fetch_replies").alias("step"), status.alias("status"),
                      _ts(as_of).alias("completed_at"), err.alias("error_message"))
    out = _changed(tables, replies=_latest(items, "replies", "comment_id", as_of),
                   ingestion_step_outcomes=Change(outs, record_outcomes, unique=tuple(OUTCOME_KEYS)))
    return out, _counts(returned, "fetch_replies")


def finalize(tables: dict, as_of, owned: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """Close every owned target from its step outcomes and every run from
    its targets, together (a retry after a partial finalise is harmless)."""
    if owned is None:
        owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"])
    fin = OC.finalize_targets(owned, tables["ingestion_step_outcomes"])
    names = OC.run_channel_names(owned, tables["videos"], tables["channels"])
    closed = OC.finalize_runs(fin).join(names, "ingestion_id", "left").select(
        "ingestion_id", "status", F.lit(None).cast("string").alias("error_message"), "channel_name")
    out = _changed(
        tables,
        ingestion_comments=Change(_runs_of(owned), lambda t, r: t.join(r, "ingestion_id", "left_anti")),
        ingestion_runs=Change(closed, lambda t, r: Q.finish_runs_merge(t, r, as_of), unique=("ingestion_id",)),
        video_processing_state=Change(fin, lambda t, r: Q.finish_targets_merge(t, r, as_of), unique=("video_id",)))
    counts = fin.groupBy("ingestion_id").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "ingestion_id", F.lit("finalize").alias("step"), "n_rows")
    return out, counts


def _cut(tables: dict, changed: set, store=None) -> dict:
    """Apply the changes to the store (or checkpoint the changed tables) in a fixed order."""
    out = {k: dict.__getitem__(tables, k) for k in tables if k != CHANGES}
    order = [n for n in sorted(changed) if n not in PUBLISH_LAST] + [n for n in PUBLISH_LAST if n in changed]
    for name in order:
        if store is not None:
            layer = next(layer for (layer, t) in S.TABLES if t == name)
            store.apply(layer, name, tables[CHANGES][name])
            out[name] = store.read(layer, name)
        else:
            out[name] = tables[name].checkpoint(eager=True)
    return out


# What a fetch step changes only if pages came: an upsert without rows is no new version.
ENTITY_TABLES = {"videos": {"videos", "video_snapshots"}, "channels": {"channels", "channel_snapshots"},
                 "commentThreads": {"comments"}, "comments": {"replies"}}


def run_ingestion(tables: dict, raw: DataFrame, ingestion_id: str, as_of, batch_size: int = 20,
                  max_comments_per_video: int = 0, max_replies_per_comment: int = 0,
                  store=None, cut_lineage: bool = True, comment_failures: DataFrame | None = None,
                  reply_failures: DataFrame | None = None) -> tuple[dict, DataFrame]:
    """claim, four fetch steps, finalise; finalise also runs when a step
    fails, then the error is raised. A run with nothing due stops after the
    claim. ``comment_failures`` and ``reply_failures`` hold failed requests
    (the columns of ``FAILURE``): their videos are FAILED in that step.
    Returns the final tables and the per-step counts."""
    Q.validate_limit(batch_size, "batch_size", allow_zero=False, most=Q.MAX_BATCH)
    Q.validate_limit(max_comments_per_video, "max_comments_per_video")
    Q.validate_limit(max_replies_per_comment, "max_replies_per_comment")
    counts = []
    own = raw.where(F.col("ingestion_id") == ingestion_id)
    fetched: set[str] = set()

    def step(fn, *a, resource: str | None = None, **kw):
        nonlocal tables
        new, c = fn(tables, *a, **kw)
        changed = set(new[CHANGES])
        if resource and resource not in fetched:
            changed -= ENTITY_TABLES[resource]
        if cut_lineage or store is not None:
            tables = _cut(new, changed, store)
        else:
            tables = {k: new[k] if k in changed else v for k, v in tables.items()}
        counts.append(c)

    step(claim, ingestion_id, as_of, batch_size)
    if not counts[0].first()["n_rows"]:
        return tables, counts[0]
    run = raw.sparkSession.range(1).select(F.lit(ingestion_id).alias("ingestion_id"))
    owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"], run)
    fetched |= {r.resource for r in own.select("resource").distinct().collect()}  # a handful of names
    try:
        step(apply_videos, own, as_of, owned, resource="videos")
        step(apply_channels, own, as_of, owned, resource="channels")
        step(apply_comments, own, as_of, owned, max_comments_per_video, comment_failures, resource="commentThreads")
        step(apply_replies, own, as_of, owned, max_replies_per_comment, reply_failures, resource="comments")
    finally:
        step(finalize, as_of, owned)
    return tables, reduce(DataFrame.unionByName, counts)
