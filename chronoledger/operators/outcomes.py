"""Per-step outcomes and their roll-up to target and run status, as sets.

Everything is computed for all runs and targets at once; no per-target
loop. Step outcomes are keyed (ingestion_id, video_id, step).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger import schemas as S


def found_outcomes(requested: DataFrame, returned: DataFrame, key: str, step: str,
                   missing_status: str, missing_message: str, completed_at=None) -> DataFrame:
    """Outcome rows for a fetch step: SUCCESS for requested ids that came
    back, ``missing_status`` with ``missing_message`` for the rest.

    ``requested``: ingestion_id, ``key``; ``returned``: ingestion_id, ``key``.
    """
    got = returned.select("ingestion_id", key).distinct().withColumn("__found", F.lit(True))
    j = requested.select("ingestion_id", key).distinct().join(got, ["ingestion_id", key], "left")
    ok = F.col("__found").isNotNull()
    done = F.lit(str(completed_at)).cast("timestamp_ntz") if completed_at is not None else F.lit(None).cast("timestamp_ntz")
    return j.select("ingestion_id", F.col(key).alias("video_id") if key != "video_id" else F.col("video_id"),
                    F.lit(step).alias("step"),
                    F.when(ok, S.ST_SUCCESS).otherwise(missing_status).alias("status"),
                    done.alias("completed_at"),
                    F.when(~ok, F.lit(missing_message)).alias("error_message"))


def missing_entities(requested: DataFrame, returned: DataFrame, keys) -> DataFrame:
    """Requested rows the source did not return (set difference, anti join)."""
    return requested.join(returned.select(*keys).distinct(), list(keys), "left_anti")


def succeeded_entities(owned: DataFrame, outcomes: DataFrame, step: str = "fetch_videos") -> DataFrame:
    """Owned (run, video) pairs whose ``step`` outcome is SUCCESS (semi join)."""
    ok = outcomes.where((F.col("step") == step) & (F.col("status") == S.ST_SUCCESS)).select(
        "ingestion_id", "video_id")
    return owned.join(ok, ["ingestion_id", "video_id"], "left_semi")


def parent_lookup(children: DataFrame, videos: DataFrame) -> DataFrame:
    """(ingestion_id, video_id, channel_id) for children present in the
    current video table (children missing there are dropped)."""
    dim = videos.select("video_id", "channel_id")
    return children.select("ingestion_id", "video_id").join(dim, "video_id", "inner").select(
        "ingestion_id", "video_id", "channel_id")


def parent_outcomes(video_channels: DataFrame, returned_channels: DataFrame,
                    completed_at=None) -> DataFrame:
    """fetch_channels outcome per video: SUCCESS when its channel came back
    in the same run; FAILED otherwise, including a NULL channel."""
    got = returned_channels.select("ingestion_id", "channel_id").distinct().withColumn("__found", F.lit(True))
    j = video_channels.join(got, ["ingestion_id", "channel_id"], "left")
    ok = F.col("__found").isNotNull()
    done = F.lit(str(completed_at)).cast("timestamp_ntz") if completed_at is not None else F.lit(None).cast("timestamp_ntz")
    return j.select("ingestion_id", "video_id", F.lit("fetch_channels").alias("step"),
                    F.when(ok, S.ST_SUCCESS).otherwise(S.ST_FAILED).alias("status"),
                    done.alias("completed_at"),
                    F.when(~ok, F.lit(S.MSG_CHANNEL_NOT_RETURNED)).alias("error_message"))


def outcomes_pivot(outcomes: DataFrame, steps=S.FETCH_STEPS) -> DataFrame:
    """One row per (run, video) with a ``struct<status, error_message>`` per
    step (NULL when the step has no outcome). Conditional aggregation over a
    fixed step list: one pass, no dynamic pivot discovery job."""
    aggs = [F.max(F.when(F.col("step") == s, F.struct("status", "error_message"))).alias(s)
            for s in steps]
    return outcomes.groupBy("ingestion_id", "video_id").agg(*aggs)


def outcomes_flat(pivoted: DataFrame, steps=S.FETCH_STEPS) -> DataFrame:
    """Pivoted outcomes as plain columns ``<step>_status`` / ``<step>_error``."""
    cols = [F.col("ingestion_id"), F.col("video_id")]
    for s in steps:
        cols += [F.col(f"{s}.status").alias(f"{s}_status"), F.col(f"{s}.error_message").alias(f"{s}_error")]
    return pivoted.select(*cols)


def rollup_status(steps=S.FETCH_STEPS) -> tuple[Column, Column]:
    """(status, error_message) over a pivoted row.

    NOT_FOUND when the video step says so (its message kept); otherwise
    FAILED when any step is missing or not SUCCESS, with one ``"step:
    error"`` per failed step in step order joined by ``"; "`` (missing or
    blank errors get the default text); otherwise SUCCESS.
    """
    per_step = F.array(*[
        F.struct(F.lit(s).alias("step"),
                 F.coalesce(F.col(f"{s}.status"), F.lit(S.ST_FAILED)).alias("status"),
                 F.nullif(F.col(f"{s}.error_message"), F.lit("")).alias("error"))
        for s in steps])
    failed = F.filter(per_step, lambda x: x["status"] != S.ST_SUCCESS)
    text = F.array_join(F.transform(failed, lambda x: F.concat(
        x["step"], F.lit(": "), F.coalesce(x["error"], F.lit(S.MSG_STEP_NOT_DONE)))), "; ")
    first = steps[0]
    not_found = F.col(f"{first}.status") == S.ST_NOT_FOUND
    status = (F.when(not_found, S.ST_NOT_FOUND)
              .when(F.size(failed) > 0, S.ST_FAILED).otherwise(S.ST_SUCCESS))
    error = (F.when(not_found, F.col(f"{first}.error_message"))
             .when(F.size(failed) > 0, text))
    return status, error


def finalize_targets(owned: DataFrame, outcomes: DataFrame, steps=S.FETCH_STEPS) -> DataFrame:
    """Final status of every owned target: ingestion_id, video_id,
    refresh_interval_hours, status, error_message."""
    piv = outcomes_pivot(outcomes.join(owned.select("ingestion_id", "video_id"),
                                       ["ingestion_id", "video_id"], "left_semi"), steps)
    j = owned.join(piv, ["ingestion_id", "video_id"], "left")
    status, error = rollup_status(steps)
    return j.select("ingestion_id", "video_id", "refresh_interval_hours",
                    status.alias("status"), error.alias("error_message"))


def finalize_runs(finalized: DataFrame) -> DataFrame:
    """Run status: SUCCESS iff every target of the run succeeded, else
    PARTIAL_SUCCESS; with target and failure counts."""
    g = finalized.groupBy("ingestion_id").agg(
        F.count(F.lit(1)).alias("targets"),
        F.count_if(F.col("status") != S.ST_SUCCESS).alias("failed"))
    return g.select("ingestion_id", "targets", "failed",
                    F.when(F.col("failed") == 0, S.RUN_SUCCESS).otherwise(S.RUN_PARTIAL).alias("status"))


def run_channel_names(owned: DataFrame, videos: DataFrame, channels: DataFrame) -> DataFrame:
    """Per run: sorted DISTINCT non-NULL titles of the channels of its
    videos joined by ``", "``; NULL when there are none. Titles are made
    distinct per run (a partial aggregate) before the per-run list is built,
    so a list holds one entry per distinct channel, not per video; a run
    owns at most its claim batch of videos, which bounds the list."""
    ch = channels.where(F.col("title").isNotNull()).select("channel_id", F.col("title").alias("channel_title"))
    names = (owned.select("ingestion_id", "video_id")
             .join(videos.select("video_id", "channel_id"), "video_id", "inner")
             .join(ch, "channel_id", "inner")
             .select("ingestion_id", "channel_title").distinct()
             .groupBy("ingestion_id")
             .agg(F.array_join(F.array_sort(F.collect_list("channel_title")), ", ").alias("channel_name")))
    runs = owned.select("ingestion_id").distinct()
    return runs.join(names, "ingestion_id", "left").select(
        "ingestion_id", F.nullif(F.col("channel_name"), F.lit("")).alias("channel_name"))


def children_by_parent(handoff: DataFrame, outcomes: DataFrame, step: str = "fetch_comments") -> DataFrame:
    """Hand-off children eligible for the next step, as rows.

    Parents (run, video) whose ``step`` succeeded, left-joined to the
    children staged by the *same* run: (ingestion_id, video_id, comment_id)
    with a NULL comment_id for a parent without children (the relational
    form of ``{video: []}``; no per-parent list is materialised)."""
    ok = outcomes.where((F.col("step") == step) & (F.col("status") == S.ST_SUCCESS)).select(
        "ingestion_id", "video_id").distinct()
    return ok.join(handoff.select("ingestion_id", "video_id", "comment_id"),
                   ["ingestion_id", "video_id"], "left")


def comment_outcomes(videos: DataFrame, failures: DataFrame, keys=("video_id",)) -> DataFrame:
    """Per-video outcome of a step fetched independently per video.

    ``failures``: (video_id, ts, attempt_id, status_code, body) of failed
    requests; the earliest failure of a video stops it. COMMENTS_DISABLED
    counts as SUCCESS (zero comments); any other error is FAILED with its
    message; videos without failures succeed."""
    from chronoledger.functions.errors import step_outcome_from_error, with_error_class
    from chronoledger.operators.dedupe import earliest_per_key

    keys = list(keys)
    first = earliest_per_key(failures.select(*keys, "ts", "attempt_id", "status_code", "body"),
                             keys, ["ts", "attempt_id"])
    first = with_error_class(first, "status_code", "body").select(*keys, "category", "message")
    j = videos.select(*keys).distinct().join(first, keys, "left")
    status, error = step_outcome_from_error("category", "message")
    return j.select(*keys, status.alias("status"), error.alias("error_message"), "category", "message")
