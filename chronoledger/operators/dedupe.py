"""Deduplication and key hygiene.

``latest_per_key`` keeps one row per key with a *deterministic* survivor: the
row with the greatest ordering struct. It is an aggregate (``max_by``), so
Spark combines before the shuffle: a key holding a third of all rows is one
row per input partition before it moves. Values of variable width make both
stages sort-based aggregates; keep the payload narrow. Keys are the grouping
columns themselves, so filters and joins on them pass through the aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _survivor(df: DataFrame, keys, order, cols, choose) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in cols if c not in keys]
    if not others:
        return df.select(*keys).distinct().select(*cols)
    row = choose(F.struct(*[F.col(c) for c in others]), F.struct(*_cols(order))).alias("__row")
    return df.groupBy(*keys).agg(row).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in cols])


def latest_per_key(df: DataFrame, keys, order, keep=None) -> DataFrame:
    """One row per ``keys``: the row whose ``struct(order)`` is greatest.

    ``order`` should end in a unique tie-break column (e.g. an id) so the
    survivor never depends on partitioning. NULL order fields sort lowest.
    ``keep`` limits the output (and the aggregated value) to those columns.
    """
    return _survivor(df, keys, order, list(keep) if keep is not None else df.columns, F.max_by)


def earliest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the row whose ``struct(order)`` is smallest."""
    return _survivor(df, keys, order, df.columns, F.min_by)


def one_per_key(df: DataFrame, keys) -> DataFrame:
    """One row per key when the survivor does not matter (rows identical or
    any is acceptable). Ordered by all columns so the result is still stable."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    return latest_per_key(df, keys, others)


def not_blank(col) -> Column:
    """Python-truthiness of a string id: not NULL and not empty."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))


def drop_blank_keys(df: DataFrame, cols) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL or the empty string."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.where(reduce(lambda a, b: a & b, [not_blank(c) for c in cols]))
