"""Bounded prefixes per group (top-n), with 0 meaning unlimited."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bounded_per_group(df: DataFrame, group, order, n: int, rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of every group in ``order`` (all rows for 0).

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so each map task forwards at most ``n`` rows per
    group: a group holding a third of all rows does not reach one task whole.
    """
    from chronoledger.operators.queue import validate_limit

    n = validate_limit(n, "limit")
    group = [group] if isinstance(group, str) else list(group)
    if n == 0:
        return df if rank_col is None else df.withColumn(
            rank_col, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    w = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    if rank_col:
        return ranked.withColumn(rank_col, F.col("__rn").cast("bigint")).drop("__rn")
    return ranked.drop("__rn")
