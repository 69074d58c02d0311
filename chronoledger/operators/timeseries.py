"""Calendar spines, last-observation-carried-forward and latest-per-entity.

The served trend asks, for every active entity and every day of a window,
for the metrics of the *latest observation taken before the end of that day*
(an unbounded left range join followed by an arg-max). Written literally that
join is O(days x observations) per entity. Here it is computed in O(output):

1. keep observations before the end of the window; fold those before its
   first day onto the first day (they seed it);
2. one arg-max per (entity, day): an aggregate with map-side combine, so a
   hot entity never lands whole in one task;
3. per entity, ``lead(day)`` gives the day the next observation takes over
   (at most ``days`` rows per entity reach this window, a proven bound);
4. ``explode(sequence(day, next_day - 1))`` writes the carried rows.

No calendar x entity cross join, no range join, no per-row Python.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _date(as_of) -> Column:
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.to_date(F.lit(str(as_of)))


def window_bounds(as_of, days: int) -> tuple[Column, Column]:
    """(first day, last day) of a ``days``-long window ending on ``as_of``."""
    end = _date(as_of)
    return F.date_sub(end, days - 1), end


def calendar(spark: SparkSession, as_of, days: int = 90, name: str = "day") -> DataFrame:
    """The ``days`` calendar dates ending at ``as_of`` (a fixed-size table)."""
    start, end = window_bounds(as_of, days)
    return spark.range(1).select(F.explode(F.sequence(start, end)).alias(name))


def calendar_spine(entities: DataFrame, key, as_of, days: int = 90, name: str = "day") -> DataFrame:
    """Every (entity, day) of the window, generated per entity row.

    Equivalent to ``calendar CROSS JOIN entities`` but planned as a Generate
    on the (already distributed) entity rows: no nested-loop join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    start, end = window_bounds(as_of, days)
    return entities.select(*keys, F.explode(F.sequence(start, end)).alias(name))


def daily_last(obs: DataFrame, key, ts: str, order_tail, carry, as_of, days: int = 90,
               name: str = "day") -> DataFrame:
    """Arg-max per (entity, day) of the ``carry`` columns, ordered by
    ``(ts, *order_tail)``; observations before the window fold onto day 1,
    observations after ``as_of`` are ignored. Returns key, day, ``__last``."""
    keys = [key] if isinstance(key, str) else list(key)
    start, end = _bounds_sql(as_of, days)
    carry = list(carry)
    order = ", ".join([ts, *order_tail])
    return (obs.where(f"{ts} < CAST(date_add({end}, 1) AS TIMESTAMP_NTZ)")
            .selectExpr(*keys, f"greatest(to_date({ts}), {start}) AS {name}",
                        f"struct({', '.join(carry)}) AS __v", f"struct({order}) AS __o")
            .groupBy(*keys, name)
            .agg(F.expr("max_by(__v, __o)").alias("__last")))


def _bounds_sql(as_of, days: int) -> tuple[str, str]:
    """SQL text of (first day, last day) of the window ending at ``as_of``."""
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    end = f"to_date('{str(as_of)[:10]}')"
    return f"date_sub({end}, {int(days) - 1})", end


def _spans(daily: DataFrame, keys: list[str], end: str, require_not_null: str | None,
           name: str) -> DataFrame:
    part = ", ".join(keys)
    spans = daily.selectExpr(
        *keys, "__last", f"{name} AS __from",
        f"coalesce(date_sub(lead({name}) OVER (PARTITION BY {part} ORDER BY {name}), 1), {end}) AS __to")
    if require_not_null:
        spans = spans.where(f"__last.{require_not_null} IS NOT NULL")
    return spans


def locf_spans(obs: DataFrame, key, ts: str, order_tail, carry, as_of, days: int = 90,
               require_not_null: str | None = None, name: str = "day") -> DataFrame:
    """LOCF before expansion: one row per (entity, observed day) with the
    carried struct ``__last`` and the day range ``[__from, __to]`` it
    covers. Decorate spans (e.g. join a dimension) before ``expand_spans``:
    there are at most as many spans as output rows, usually far fewer."""
    keys = [key] if isinstance(key, str) else list(key)
    _, end = _bounds_sql(as_of, days)
    daily = daily_last(obs, keys, ts, order_tail, list(carry), as_of, days, name)
    return _spans(daily, keys, end, require_not_null, name)


def daily_rollup(obs: DataFrame, key, ts: str, order_tail, carry, name: str = "day") -> DataFrame:
    """Maintained rollup: arg-max per (entity, calendar day) over the whole
    history, keeping the ordering struct ``__o`` so rollups of new
    snapshots can be merged in (``merge_rollups``). One row per entity and
    day instead of every snapshot; store it partitioned by day."""
    keys = [key] if isinstance(key, str) else list(key)
    order = ", ".join([ts, *order_tail])
    return (obs.selectExpr(*keys, f"to_date({ts}) AS {name}", f"struct({', '.join(carry)}) AS __v",
                           f"struct({order}) AS __o")
            .groupBy(*keys, name)
            .agg(F.expr("max_by(__v, __o)").alias("__last"), F.expr("max(__o)").alias("__o")))


def merge_rollups(current: DataFrame, new: DataFrame, key, name: str = "day") -> DataFrame:
    """Fold a rollup of newly arrived snapshots into the maintained one."""
    keys = [key] if isinstance(key, str) else list(key)
    return (current.unionByName(new).groupBy(*keys, name)
            .agg(F.expr("max_by(__last, __o)").alias("__last"), F.expr("max(__o)").alias("__o")))


def locf_spans_from_rollup(rollup: DataFrame, key, as_of, days: int = 90,
                           require_not_null: str | None = None, name: str = "day") -> DataFrame:
    """``locf_spans`` computed from a ``daily_rollup`` instead of raw
    snapshots: identical result. Rollup days before the window fold onto
    its first day (their arg-max seeds it), so the seed reads one row per
    entity and day of history rather than every snapshot."""
    keys = [key] if isinstance(key, str) else list(key)
    start, end = _bounds_sql(as_of, days)
    daily = (rollup.where(f"{name} <= {end}")
             .selectExpr(*keys, f"greatest({name}, {start}) AS {name}", "__last", "__o")
             .groupBy(*keys, name).agg(F.expr("max_by(__last, __o)").alias("__last")))
    return _spans(daily, keys, end, require_not_null, name)


def seed_day(as_of, days: int) -> _dt.date:
    """The day whose seed a window needs: the first of the month in which it begins."""
    end = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
    start = _dt.date(end.year, end.month, end.day) - _dt.timedelta(days=days - 1)
    return start.replace(day=1)


def next_seed(seed: DataFrame | None, rollup: DataFrame, key, since, until, name: str = "day") -> DataFrame:
    """Maintained seed: each entity's latest rollup row before the day
    ``until`` (key, ``seed_day``, ``__last``, ``__o``), from the seed of the
    day ``since`` and the rollup's days between (from the whole rollup
    without one). Store it partitioned by ``seed_day``, a day for each month."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = rollup.where(f"{name} < to_date('{until}')").select(*keys, "__last", "__o")
    if seed is not None:
        rows = rollup.where(f"{name} >= to_date('{since}') AND {name} < to_date('{until}')").select(*keys, "__last", "__o")
        rows = rows.unionByName(seed.where(f"seed_day = to_date('{since}')").select(*keys, "__last", "__o"))
    return rows.groupBy(*keys).agg(F.expr("max_by(__last, __o)").alias("__last"), F.expr("max(__o)").alias("__o")).select(
        *keys, F.expr(f"to_date('{until}')").alias("seed_day"), "__last", "__o")


def locf_spans_from_seed(rollup: DataFrame, seeds: DataFrame, key, as_of, days: int = 90,
                         require_not_null: str | None = None, name: str = "day") -> DataFrame:
    """``locf_spans_from_rollup`` that reads no history: the rollup from the
    seed's day on, and that day's seed. Both filters are literal days, so
    partitions by ``name`` and ``seed_day`` are pruned."""
    keys = [key] if isinstance(key, str) else list(key)
    start, end = _bounds_sql(as_of, days)
    since = f"to_date('{seed_day(as_of, days)}')"
    rows = rollup.where(f"{name} >= {since} AND {name} <= {end}").selectExpr(*keys, f"greatest({name}, {start}) AS {name}", "__last", "__o")
    rows = rows.unionByName(seeds.where(f"seed_day = {since}").selectExpr(*keys, f"{start} AS {name}", "__last", "__o"))
    daily = rows.groupBy(*keys, name).agg(F.expr("max_by(__last, __o)").alias("__last"))
    return _spans(daily, keys, end, require_not_null, name)


def expand_spans(spans: DataFrame, carry, name: str = "day") -> DataFrame:
    """One row per day of every span, with the carried columns unpacked."""
    others = [c for c in spans.columns if c not in ("__last", "__from", "__to")]
    return spans.selectExpr(*others, f"explode(sequence(__from, __to)) AS {name}",
                            *[f"__last.{c} AS {c}" for c in carry])


def total_by_day_from_spans(spans: DataFrame, metric: str, alias: str, name: str = "day") -> DataFrame:
    """Per-day sum of a carried (non-NULL) metric over all entities, without
    expanding spans into days: each span adds ``+v`` on its first day and
    ``-v`` the day after its last; a running sum over the (at most
    ``days + 1``) distinct change days gives the totals. Days that no span
    covers produce no row. Work is O(spans); the final window sees one row
    per change day, a bound set by the window length."""
    v = f"__last.{metric}"
    deltas = spans.selectExpr(
        f"inline(array(named_struct('d', __from, 'v', {v}, 'n', 1L), "
        f"named_struct('d', date_add(__to, 1), 'v', -{v}, 'n', -1L)))")
    per_day = deltas.groupBy("d").agg(F.sum("v").alias("dv"), F.sum("n").alias("dn"))
    running = per_day.selectExpr(
        "d", "sum(dv) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total",
        "sum(dn) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS covering",
        "lead(d) OVER (ORDER BY d) AS next_d")
    # every day from a change day up to the next change day has the same total
    return (running.where("covering > 0")
            .selectExpr(f"explode(sequence(d, date_sub(next_d, 1))) AS {name}", f"CAST(total AS BIGINT) AS {alias}"))


def locf(obs: DataFrame, key, ts: str, order_tail, carry, as_of, days: int = 90,
         require_not_null: str | None = None, name: str = "day") -> DataFrame:
    """Last observation carried forward over a ``days`` window.

    Returns key, ``name`` (date) and every ``carry`` column taken from the
    latest observation at or before the end of that day. Days before an
    entity's first observation produce no row. If ``require_not_null`` is
    given, days whose carried value of that column is NULL are dropped (the
    carried *row* is the latest one, even when its metric is NULL).
    """
    spans = locf_spans(obs, key, ts, order_tail, carry, as_of, days, require_not_null, name)
    return expand_spans(spans, list(carry), name)


def last_at_or_before(entities: DataFrame, obs: DataFrame, key, ts: str, order_tail, carry,
                      as_of, days: int = 90, name: str = "day") -> DataFrame:
    """The left range join ``spine LEFT JOIN obs ON key AND obs.ts < day + 1``
    reduced by arg-max per (entity, day), *including* days before the first
    observation (NULL carried columns). Computed in O(output): the first span
    of each entity is extended back to the window start with NULLs, and
    entities without observations get an all-NULL spine; no pairs emitted."""
    keys = [key] if isinstance(key, str) else list(key)
    carry = list(carry)
    start, end = window_bounds(as_of, days)
    ents = entities.select(*keys).distinct()
    daily = daily_last(obs.join(ents, keys, "left_semi"), keys, ts, order_tail, carry,
                       as_of, days, name)
    w = Window.partitionBy(*keys).orderBy(name)
    spans = daily.select(
        *keys, "__last", F.col(name).alias("__from"),
        F.when(F.lag(name).over(w).isNull(), start).otherwise(F.col(name)).alias("__ext"),
        F.coalesce(F.date_sub(F.lead(name).over(w), 1), end).alias("__to"))
    seen = spans.select(*keys, F.explode(F.sequence("__ext", "__to")).alias(name), "__from", "__last")
    seen = seen.select(*keys, name, *[
        F.when(F.col(name) >= F.col("__from"), F.col(f"__last.{c}")).alias(c) for c in carry])
    types = dict(obs.dtypes)
    unseen = calendar_spine(ents.join(daily.select(*keys), keys, "left_anti"), keys, as_of, days, name)
    unseen = unseen.select(*keys, name, *[F.lit(None).cast(types[c]).alias(c) for c in carry])
    return seen.unionByName(unseen)
