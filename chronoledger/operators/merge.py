"""Keyed table maintenance as pure functions ``(target, source) -> new target``.

Without a transactional table format there is no row-level MERGE; instead each
operator returns the full next version of the table, which the caller
publishes (``sources.tables.TableStore.publish``). Semantics follow SQL MERGE:

* a source row *matches* a target row when every key is equal (``=``, so NULL
  keys never match and a null-key source row is inserted);
* ``update`` is ``"*"`` (copy every target column from the source), ``None``
  (no WHEN MATCHED clause) or ``{column: expression}``; expressions are SQL
  text or Columns that reference the target as ``t.`` and the source as ``s.``;
  target columns not named keep their value;
* ``insert`` is ``"*"``, ``None`` (no WHEN NOT MATCHED clause) or
  ``{column: expression}`` over ``s.`` only; unnamed columns are NULL;
* ``matched_condition`` restricts the update (``WHEN MATCHED AND ...``).

Physical plans. No Spark job runs while a plan is built. By default one outer
join shuffles both sides on the key (sort-merge, spill-safe; adaptive
execution replaces it by a broadcast where the side's real size allows).
``strategy="broadcast"`` is for sources bounded by construction, such as a
claim batch: the target is then never shuffled. Matched and unchanged rows
come from ``target LEFT JOIN broadcast(source)`` and inserts from
``source ANTI JOIN (target keys SEMI broadcast(source keys))``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_T, _S = "__t_present", "__s_present"


def _as_col(expr) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _conform_source(target: DataFrame, source: DataFrame, update, insert) -> DataFrame:
    """Cast star-copied source columns to the target's types."""
    if update != "*" and insert != "*":
        return source
    tt = dict(target.dtypes)
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns for '*': {missing}")
    return source.select(*[
        (F.col(c).cast(tt[c]).alias(c) if c in tt else F.col(c)) for c in source.columns
    ])


def _projection(target: DataFrame, update, insert, matched_cond: Column | None,
                with_inserts: bool) -> list[Column]:
    t_here = F.col(f"t.{_T}").isNotNull()
    s_here = F.col(f"s.{_S}").isNotNull()
    matched = t_here & s_here
    if matched_cond is not None:
        matched = matched & F.coalesce(matched_cond, F.lit(False))
    types = dict(target.dtypes)
    out = []
    for c in target.columns:
        keep = F.col(f"t.{c}")
        if update is None:
            value = keep
        elif update == "*":
            value = F.when(matched, F.col(f"s.{c}")).otherwise(keep)
        elif c in update:
            value = F.when(matched, _as_col(update[c]).cast(types[c])).otherwise(keep)
        else:
            value = keep
        if with_inserts:
            if insert == "*":
                ins = F.col(f"s.{c}")
            elif c in insert:
                ins = _as_col(insert[c]).cast(types[c])
            else:
                ins = F.lit(None).cast(types[c])
            value = F.when(~t_here, ins).otherwise(value)
        out.append(value.alias(c))
    return out


def _insert_projection(target: DataFrame, insert) -> list[Column]:
    types = dict(target.dtypes)
    out = []
    for c in target.columns:
        if insert == "*":
            v = F.col(f"s.{c}")
        elif c in insert:
            v = _as_col(insert[c]).cast(types[c])
        else:
            v = F.lit(None).cast(types[c])
        out.append(v.alias(c))
    return out


def _checked(source: DataFrame, keys: list[str]) -> DataFrame:
    """Fail, when the plan runs, on a key that a source holds twice."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (source.withColumn("__n", n)
            .where(F.when(known & (F.col("__n") > 1), F.raise_error(F.lit(f"merge source repeats a key of {keys}"))).otherwise(F.lit(True)))
            .drop("__n"))


def merge(target: DataFrame, source: DataFrame, on, update="*", insert="*",
          matched_condition=None, strategy: str = "shuffle", insert_condition=None,
          check_keys: bool = False) -> DataFrame:
    """Return the next version of ``target`` after a MERGE with ``source``.

    ``strategy``: ``"shuffle"``, or ``"broadcast"`` for a source that is
    bounded by construction. ``check_keys`` makes the job fail if the source
    holds a key twice.
    """
    keys = _keys(on)
    if update is None and insert is None:
        return target
    source = _conform_source(target, source, update, insert)
    if check_keys:
        source = _checked(source, keys)
    if insert_condition is not None and insert is not None:
        # WHEN NOT MATCHED AND <cond>: unmatched source rows failing it are
        # not inserted; it refers to the source only, so marking them first
        # keeps both plans identical.
        source = source.alias("s").withColumn("__ins_ok", F.coalesce(_as_col(insert_condition), F.lit(False)))
    cond_col = _as_col(matched_condition) if matched_condition is not None else None

    t = target.withColumn(_T, F.lit(True)).alias("t")
    s = source.withColumn(_S, F.lit(True)).alias("s")
    key_eq = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])

    if strategy == "shuffle":
        how = "full_outer" if insert is not None else "left"
        if update is None:
            # insert-only: the target passes through; only new keys are added
            new = source.alias("s").join(target.select(*keys), keys, "left_anti")
            if insert_condition is not None:
                new = new.where(F.col("__ins_ok"))
            return target.unionByName(new.select(*_insert_projection(target, insert)))
        joined = t.join(s, key_eq, how)
        if insert_condition is not None and insert is not None:
            joined = joined.where(F.col(f"t.{_T}").isNotNull() | F.col("s.__ins_ok"))
        return joined.select(*_projection(target, update, insert, cond_col, insert is not None))

    # broadcast plan: the target is scanned but never shuffled
    if update is None:
        kept = target
    else:
        kept = t.join(F.broadcast(s), key_eq, "left").select(
            *_projection(target, update, insert, cond_col, False))
    if insert is None:
        return kept
    src_keys = source.select(*keys).where(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    # distinct: at most the source's keys, and so bounded as they are
    matched_keys = target.select(*keys).join(F.broadcast(src_keys), keys, "left_semi").distinct()
    new = source.alias("s").join(F.broadcast(matched_keys), keys, "left_anti")
    if insert_condition is not None:
        new = new.where(F.col("__ins_ok"))
    return kept.unionByName(new.select(*_insert_projection(target, insert)))


def rows_to_insert(target: DataFrame, source: DataFrame, on) -> DataFrame:
    """The source rows an insert-only merge adds (keys absent from the
    target), in target column order. For append-only tables this is what
    gets *appended*: the stored history is never rewritten."""
    keys = _keys(on)
    source = _conform_source(target, source, None, "*")
    new = source.alias("s").join(target.select(*keys), keys, "left_anti")
    return new.select(*_insert_projection(target, "*"))


def upsert(target: DataFrame, source: DataFrame, on, **kw) -> DataFrame:
    """WHEN MATCHED UPDATE SET * / WHEN NOT MATCHED INSERT * (last write wins)."""
    return merge(target, source, on, update="*", insert="*", **kw)


def insert_only(target: DataFrame, source: DataFrame, on, **kw) -> DataFrame:
    """WHEN NOT MATCHED INSERT *: existing rows are never changed (first write wins)."""
    return merge(target, source, on, update=None, insert="*", **kw)


def update_only(target: DataFrame, source: DataFrame, on, update, **kw) -> DataFrame:
    """WHEN MATCHED UPDATE only: unmatched source rows are ignored."""
    return merge(target, source, on, update=update, insert=None, **kw)


def source_conflicts(source: DataFrame, on) -> DataFrame:
    """Keys that appear more than once in a merge source (ambiguous MERGE)."""
    keys = _keys(on)
    return (source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def update_where(df: DataFrame, predicate, assignments: dict) -> DataFrame:
    """``UPDATE df SET c = v, ... WHERE predicate`` (NULL predicate = no change)."""
    pred = F.coalesce(_as_col(predicate), F.lit(False))
    types = dict(df.dtypes)
    return df.select(*[
        (F.when(pred, _as_col(assignments[c]).cast(types[c])).otherwise(F.col(c)).alias(c)
         if c in assignments else F.col(c))
        for c in df.columns
    ])


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """``DELETE FROM df WHERE predicate``: only rows where it is TRUE go."""
    return df.where(~F.coalesce(_as_col(predicate), F.lit(False)))


def replace_slice(target: DataFrame, slice_column: str, slice_values: DataFrame,
                  rows: DataFrame, required: list[str], dedupe_keys: list[str]) -> DataFrame:
    """Replace whole slices (e.g. one run's hand-off rows) of a table.

    Every target row whose ``slice_column`` value appears in ``slice_values``
    is deleted; ``rows`` with a null or empty ``required`` column are
    dropped, the rest deduplicated on ``dedupe_keys`` and appended.
    """
    from chronoledger.operators.dedupe import drop_blank_keys, one_per_key


    sv = slice_values.select(slice_column).distinct()
    kept = target.join(sv, slice_column, "left_anti")
    fresh = one_per_key(drop_blank_keys(rows.select(*target.columns), required), dedupe_keys)
    return kept.unionByName(fresh)


def change_feed(before: DataFrame, after: DataFrame, on) -> DataFrame:
    """Row-level change feed between two versions of a keyed table.

    Output: every column plus ``_change_type`` in {insert, delete,
    update_preimage, update_postimage}; unchanged rows are omitted.
    Comparison is null-safe over all non-key columns.
    """
    keys = _keys(on)
    cols = list(after.columns)
    b = before.select(*cols).withColumn(_T, F.lit(True)).alias("b")
    a = after.select(*cols).withColumn(_S, F.lit(True)).alias("a")
    key_eq = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys])
    j = b.join(a, key_eq, "full_outer")
    b_row = F.struct(*[F.col(f"b.{c}").alias(c) for c in cols])
    a_row = F.struct(*[F.col(f"a.{c}").alias(c) for c in cols])
    b_here, a_here = F.col(f"b.{_T}").isNotNull(), F.col(f"a.{_S}").isNotNull()
    same = b_row.eqNullSafe(a_row)

    def tagged(row, kind):
        return F.struct(row.alias("r"), F.lit(kind).alias("k"))

    changes = (F.when(b_here & ~a_here, F.array(tagged(b_row, "delete")))
               .when(~b_here & a_here, F.array(tagged(a_row, "insert")))
               .when(b_here & a_here & ~same,
                     F.array(tagged(b_row, "update_preimage"), tagged(a_row, "update_postimage"))))
    return (j.select(F.explode(changes).alias("c"))
            .select(*[F.col(f"c.r.{c}").alias(c) for c in cols], F.col("c.k").alias("_change_type")))
