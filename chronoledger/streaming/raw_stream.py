"""Continuous reprocessing of the append-only raw table.

The raw table (``raw.api_responses``) only ever grows, so it can be read as
a stream. Two ways to follow it:

* ``start`` upserts each micro-batch's pages into the current-state tables;
* ``start_steps`` does a run's whole step for a resource: current state,
  snapshots, hand-off and outcomes. A micro-batch may hold some of a run's
  pages, and what a step says of a video depends on all of them (a video that
  is on no page is NOT_FOUND). So a micro-batch only tells which runs have new
  pages, and the batch step is done again over all stored pages of these runs:
  the result is that of the batch, whatever the order and the cut of
  micro-batches, and a replayed one changes nothing.

Rows carry the time at which their page was received beside them, in the
batch steps as well: a page that arrives late never replaces what a newer
page said, and a newer page always does, whichever way came first. Progress
is kept in the query's checkpoint location, which must be on shared storage
on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.operators import normalize as N
from chronoledger.operators import queue as Q
from chronoledger.operators.dedupe import latest_per_key
from chronoledger.plans import ingest as IG
from chronoledger.sources.tables import RECEIVED, Change

_ENTITY = {
    "videos": ("silver", "videos", "video_id", N.normalize_videos),
    "channels": ("silver", "channels", "channel_id", N.normalize_channels),
    "commentThreads": ("silver", "comments", "comment_id", N.normalize_comments),
    "comments": ("silver", "replies", "comment_id", N.normalize_replies),
}
STEPS = {"videos": IG.apply_videos, "channels": IG.apply_channels, "commentThreads": IG.apply_comments, "comments": IG.apply_replies}


def raw_stream(spark: SparkSession, raw_path: str) -> DataFrame:
    """Stream of raw pages appended under ``raw_path``: parquet files laid
    out like the stored raw table (``resource=<name>/`` partition folders;
    the resource column comes from the folder name)."""
    return spark.readStream.schema(S.API_RESPONSES).parquet(raw_path)


def merge_batch(store, batch: DataFrame, resource: str) -> int | None:
    """Normalise one micro-batch of pages and upsert it into its table; no
    pages, no new version."""
    layer, table, key, normalizer = _ENTITY[resource]
    pages = batch.where(F.col("resource") == resource)
    if pages.isEmpty():
        return None
    cols = [f.name for f in S.TABLES[(layer, table)].fields if f.name != "ingested_at"]
    latest = latest_per_key(normalizer(pages), key, IG.ITEM_ORDER)
    rows = latest.select(*cols, F.col("received_at").alias("ingested_at"), F.col("received_at").alias(RECEIVED))
    return store.apply(layer, table, Change(rows, lambda t, r: IG.upsert_newer(t, r, key), unique=(key,)))


def step_batch(store, batch: DataFrame, raw: DataFrame, resource: str, as_of) -> None:
    """Do the step of ``resource`` again for each run with pages in ``batch``,
    over all its pages in ``raw``. Steps that build on it (replies on
    comments, channels on videos) follow, so that pages may come in any order."""
    runs = batch.where(F.col("resource") == resource).select("ingestion_id").distinct()
    if runs.isEmpty():
        return
    order = list(STEPS)
    pages = raw.join(runs, "ingestion_id", "left_semi")
    for later in order[order.index(resource):]:
        tables = {t: store.read(layer, t) for (layer, t) in S.TABLES if t != "api_responses"}
        owned = Q.owned_targets(tables["video_targets"], tables["video_processing_state"], runs)
        new, _ = STEPS[later](tables, pages, as_of, owned)
        IG._cut(new, set(new[IG.CHANGES]), store)


def _follow(spark: SparkSession, raw_path: str, per_batch, checkpoint_location: str, available_now: bool):
    w = (raw_stream(spark, raw_path).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint_location))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def start(spark: SparkSession, raw_path: str, store, checkpoint_location: str,
          resources=("videos", "channels", "commentThreads", "comments"), available_now: bool = True):
    """Start the reprocessing query; with ``available_now`` it processes
    what is there and stops (batch-style scheduling of a streaming job)."""

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            for r in resources:
                merge_batch(store, batch, r)
        finally:
            batch.unpersist()
    return _follow(spark, raw_path, per_batch, checkpoint_location, available_now)


def start_steps(spark: SparkSession, raw_path: str, store, checkpoint_location: str, as_of, available_now: bool = True):
    """Start the query that does whole steps: those of the earliest resource
    in a micro-batch, and all that build on it."""

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        raw = spark.read.schema(S.API_RESPONSES).parquet(raw_path)
        found = {r.resource for r in batch.select("resource").distinct().collect()}  # a handful of names
        first = next((r for r in STEPS if r in found), None)
        if first is not None:
            step_batch(store, batch.withColumn("resource", F.lit(first)), raw, first, as_of)
    return _follow(spark, raw_path, per_batch, checkpoint_location, available_now)
