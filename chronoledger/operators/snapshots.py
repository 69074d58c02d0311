"""Immutable metric snapshots projected from current-state rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger import schemas as S
from chronoledger.operators.dedupe import drop_blank_keys


def snapshot_rows(current: DataFrame, entity: str, ingestion_id, collected_at) -> DataFrame:
    """Entity key, run id, observation time and the entity's three metrics;
    rows with a NULL or empty key are dropped."""
    key, metrics = S.SNAPSHOT_METRICS[entity]
    run = ingestion_id if isinstance(ingestion_id, Column) else F.lit(str(ingestion_id))
    at = collected_at if isinstance(collected_at, Column) else F.lit(str(collected_at)).cast("timestamp_ntz")
    return drop_blank_keys(current, [key]).select(
        key, run.cast("string").alias("ingestion_id"), at.alias("collected_at"), *metrics)
