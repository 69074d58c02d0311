"""The due-work queue: eligibility, claim order, claiming and releasing.

A target is due when it is active and either has no state yet, is not being
processed and its refresh time is unset or reached, or is PROCESSING under a
claim older than the stale-claim interval (a crashed worker). The claim order
is: never-succeeded first, priority descending, next refresh ascending with
NULLs first, then id. ``claim_due`` is a top-k (``orderBy`` + ``limit``):
Spark keeps ``k`` rows per partition and merges them, so no global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.operators import merge as M


def as_ts(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


# A claimed batch is broadcast and listed by the driver.
MAX_BATCH = 100_000


def validate_limit(value, name: str, allow_zero: bool = True, most: int | None = None) -> int:
    """Parse a job limit: an integer >= 0 (> 0 when zero is not allowed), at most ``most``."""
    try:
        limit = int(str(value).strip())
    except ValueError as exc:
        raise ValueError(f"{name} must be an integer") from exc
    if limit < 0 or (not allow_zero and limit == 0):
        raise ValueError(f"{name} must be {'>= 0' if allow_zero else '> 0'}")
    if most is not None and limit > most:
        raise ValueError(f"{name} must be <= {most}")
    return limit


def is_due(as_of, stale_after: str = S.STALE_CLAIM_INTERVAL, prefix: str = "") -> Column:
    """Eligibility over a targets LEFT JOIN state row (state columns may be NULL)."""
    p = prefix
    now = as_ts(as_of)
    no_state = F.col(f"{p}state_video_id").isNull()
    idle = (F.col(f"{p}status") != S.ST_PROCESSING) & (
        F.col(f"{p}next_refresh_at").isNull() | (F.col(f"{p}next_refresh_at") <= now))
    stale = (F.col(f"{p}status") == S.ST_PROCESSING) & (
        F.col(f"{p}claimed_at") < now - F.expr(f"INTERVAL {stale_after}"))
    return no_state | idle | stale


def queue_order() -> list[Column]:
    return [
        F.when(F.col("last_succeeded_at").isNull(), 0).otherwise(1).asc(),
        F.col("priority").desc(),
        F.col("next_refresh_at").asc_nulls_first(),
        F.col("video_id").asc(),
    ]


def due_targets(targets: DataFrame, state: DataFrame, as_of,
                stale_after: str = S.STALE_CLAIM_INTERVAL) -> DataFrame:
    """All due targets with the columns the claim order needs."""
    st = state.select(F.col("video_id").alias("state_video_id"), "status", "claimed_at",
                      "next_refresh_at", "last_succeeded_at")
    j = targets.join(st, targets.video_id == st.state_video_id, "left")
    return j.where(F.col("is_active") & is_due(as_of, stale_after))


def claim_due(targets: DataFrame, state: DataFrame, as_of, batch_size: int,
              stale_after: str = S.STALE_CLAIM_INTERVAL) -> DataFrame:
    """The next ``batch_size`` due targets in queue order (video_id, hours)."""
    n = validate_limit(batch_size, "batch_size", allow_zero=False, most=MAX_BATCH)
    return (due_targets(targets, state, as_of, stale_after)
            .orderBy(*queue_order()).limit(n)
            .select("video_id", "refresh_interval_hours"))


def stale_claims(state: DataFrame, as_of, stale_after: str = S.STALE_CLAIM_INTERVAL) -> DataFrame:
    """PROCESSING rows whose claim is older than the interval (strictly)."""
    return state.where((F.col("status") == S.ST_PROCESSING)
                       & (F.col("claimed_at") < as_ts(as_of) - F.expr(f"INTERVAL {stale_after}")))


def claim_merge(state: DataFrame, claimed: DataFrame, ingestion_id, claimed_at,
                strategy: str = "broadcast") -> DataFrame:
    """Mark claimed targets PROCESSING under ``ingestion_id``.

    Matched: status PROCESSING, claim and attempt time stamped, attempt count
    + 1, run id set, error cleared. New: inserted with attempt count 1. The
    claimed set is the output of a ``limit``, so it is bounded by the batch
    size and is broadcast (the state table is not shuffled).
    """
    src = claimed.select(
        "video_id",
        (F.col("ingestion_id") if "ingestion_id" in claimed.columns else F.lit(ingestion_id))
        .cast("string").alias("ingestion_id"),
        (F.col("claimed_at") if "claimed_at" in claimed.columns else as_ts(claimed_at)).alias("claimed_at"),
    )
    return M.merge(
        state, src, "video_id",
        update={"status": F.lit(S.ST_PROCESSING), "claimed_at": "s.claimed_at",
                "last_attempt_at": "s.claimed_at", "last_ingestion_id": "s.ingestion_id",
                "attempt_count": "t.attempt_count + 1", "error_message": F.lit(None)},
        insert={"video_id": "s.video_id", "status": F.lit(S.ST_PROCESSING),
                "claimed_at": "s.claimed_at", "last_attempt_at": "s.claimed_at",
                "attempt_count": F.lit(1), "last_ingestion_id": "s.ingestion_id"},
        strategy=strategy)


def next_refresh(completed_at, hours) -> Column:
    """Completion time plus a column-valued number of hours."""
    h = F.col(hours) if isinstance(hours, str) else hours
    c = F.col(completed_at) if isinstance(completed_at, str) else completed_at
    return c + F.make_dt_interval(F.lit(0), h.cast("int"))


def finish_targets_merge(state: DataFrame, finished: DataFrame, completed_at=None,
                         require_owner: bool = False, strategy: str = "shuffle") -> DataFrame:
    """Release finished targets (update only; unmatched rows are ignored).

    ``finished``: video_id, ingestion_id, status, error_message,
    refresh_interval_hours and optionally completed_at. Sets the status,
    clears the claim, stamps ``last_succeeded_at`` only on SUCCESS, sets
    ``first_processed_at`` once, schedules ``next_refresh_at`` =
    completion + interval, records the run id and the error; the attempt
    count is untouched. ``require_owner`` additionally requires the state
    row to still belong to the finishing run.
    """
    done = F.col("completed_at") if "completed_at" in finished.columns else as_ts(completed_at)
    src = finished.select("video_id", "ingestion_id", "status", "error_message",
                          done.alias("completed_at"),
                          next_refresh(done, "refresh_interval_hours").alias("next_refresh_at"))
    ok = F.col("s.status") == S.ST_SUCCESS
    return M.merge(
        state, src, "video_id",
        update={
            "status": "s.status",
            "claimed_at": F.lit(None),
            "last_succeeded_at": F.when(ok, F.col("s.completed_at")).otherwise(F.col("t.last_succeeded_at")),
            "first_processed_at": F.coalesce(F.col("t.first_processed_at"),
                                             F.when(ok, F.col("s.completed_at"))),
            "next_refresh_at": F.coalesce(F.col("s.next_refresh_at"), F.col("t.next_refresh_at")),
            "last_ingestion_id": "s.ingestion_id",
            "error_message": "s.error_message",
        },
        insert=None,
        matched_condition="t.last_ingestion_id = s.ingestion_id" if require_owner else None,
        strategy=strategy)


def open_runs(spark, ingestion_ids: DataFrame, started_at=None,
              source: str = S.RUN_SOURCE_LABEL) -> DataFrame:
    """RUNNING run rows (to append) for the given run ids."""
    start = F.col("started_at") if "started_at" in ingestion_ids.columns else as_ts(started_at)
    return ingestion_ids.select(
        F.col("ingestion_id").cast("string"), F.lit(source).alias("channel_handle"),
        F.lit(None).cast("string").alias("channel_name"), start.alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("ended_at"), F.lit(S.RUN_RUNNING).alias("status"),
        F.lit(None).cast("string").alias("error_message"))


def finish_runs_merge(runs: DataFrame, finished: DataFrame, ended_at=None,
                      strategy: str = "shuffle") -> DataFrame:
    """Close runs: end time, status and error set; the channel name is only
    replaced when the new one is not NULL (the error is replaced even by NULL)."""
    end = F.col("ended_at") if "ended_at" in finished.columns else as_ts(ended_at)
    src = finished.select("ingestion_id", "status", "error_message", "channel_name",
                          end.alias("ended_at"))
    return M.merge(
        runs, src, "ingestion_id",
        update={"ended_at": "s.ended_at", "status": "s.status", "error_message": "s.error_message",
                "channel_name": F.coalesce(F.col("s.channel_name"), F.col("t.channel_name"))},
        insert=None, strategy=strategy)


def owned_targets(targets: DataFrame, state: DataFrame, ingestion_ids: DataFrame | None = None) -> DataFrame:
    """(ingestion_id, video_id, refresh_interval_hours) of targets still
    PROCESSING under the run that claimed them; all runs at once unless
    ``ingestion_ids`` restricts them (semi join)."""
    st = state.where(F.col("status") == S.ST_PROCESSING).select(
        "video_id", F.col("last_ingestion_id").alias("ingestion_id"))
    if ingestion_ids is not None:
        st = st.join(ingestion_ids.select("ingestion_id").distinct(), "ingestion_id", "left_semi")
    return targets.select("video_id", "refresh_interval_hours").join(st, "video_id", "inner").select(
        "ingestion_id", "video_id", "refresh_interval_hours")


def request_batches(ids: DataFrame, id_col: str, bucket: Column, batch_size: int = S.REQUEST_BATCH_SIZE,
                    group_cols=()) -> DataFrame:
    """Pack ids into comma-joined request batches of at most ``batch_size``.

    Ids are numbered within ``bucket``, an expression over the row that must
    bound a bucket's ids (a range of ids, a hash whose count follows the
    data): the result depends on it and on no setting of the session.
    Output: *group_cols, bucket, batch_no, n_ids, ids.
    """
    n = validate_limit(batch_size, "batch_size", allow_zero=False)
    g = list(group_cols)
    x = ids.select(*g, F.col(id_col), bucket.alias("bucket")).distinct()
    w = Window.partitionBy(*g, "bucket").orderBy(id_col)
    x = x.withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / n).cast("bigint"))
    return (x.groupBy(*g, "bucket", "batch_no")
            .agg(F.count(F.lit(1)).alias("n_ids"),
                 F.array_join(F.array_sort(F.collect_list(F.col(id_col).cast("string"))), ",").alias("ids")))
