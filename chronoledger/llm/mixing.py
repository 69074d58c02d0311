"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted for each cell (source, language, topic); the cells' token
shares are raked: scaled in turn so that their sums over each source, each
language and each topic are the targets', until no sum is off by more than
``TOLERANCE``. Where targets can't be met together (a source that alone has
a language, with another goal) rounds end when they lessen the error no
more; ``misfit`` is the largest sum's error that is left.

A document's ``weight`` is its cell's raked share over the cell's token
share, times ``keep``: the number of copies that would keep that share of
all tokens. ``repeated`` gives as many copies as the weight's whole part,
and one more with the probability of the rest, by a hash of its id: the same
on every run and partitioning. Without repeats no document can count twice:
``probability`` is the weight at the highest rate, at most ``keep``, at
which no weight exceeds 1, so that sums expected of the sample are the
targets' as well; ``sampled`` and ``mix`` draw by it.

Dimensions are columns of the caller's (``names``), by default source, lang
and ``topic_of`` the text. Targets are shares by name, or a power: the
dimension's own shares raised to it (below 1 evens them out). Names without
a target keep nothing.

Cells are the only table of the fitting. Up to ``FEW_CELLS`` of them are
fitted as arrays; of more, a step is one aggregate over them and a join of
its sums (a broadcast if the dimension's names take at most
``BROADCAST_BYTES``), written to the shared folder. Both do the same steps.
Texts are read once for counts; ``sampled`` needs no more, and the others
read them once again.

Defined cases: a NULL name is ``(none)``, a NULL text has no tokens and
counts with its cell; a cell without tokens keeps no weight; equal ids share
their fate; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import WORD, dropped, shared_folder, whole_text, written

TARGETS: dict[str, float | dict[str, float]] = {"source": 0.5, "lang": 0.7, "topic": 0.9}
DIMENSIONS = list(TARGETS)
TOLERANCE, STALLED, KEEP, SEED = 1e-12, 0.999, 0.7, "mix"
FEW_CELLS, BROADCAST_BYTES = 200_000, 16 << 20
LEGAL = "licen[sc]e|rights reserved"


def topic_of(text: Column) -> Column:
    """A topic by form: legal notices, listings, data, short notes, prose."""
    lower = F.lower(text)
    return (F.when(lower.rlike(LEGAL), "legal").when(F.regexp_count(text, F.lit(r"\|")) >= 5, "listing")
            .when(F.regexp_count(text, F.lit("[0-9]")) * 20 >= F.length(text), "data")
            .when(F.length(text) < 600, "note").otherwise("prose"))


def default_names() -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(whole_text())}


def _named(names: dict[str, Column] | None) -> list[Column]:
    return [F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in (names or default_names()).items()]


def _goals(cells: DataFrame, dimension: str, target: float | dict[str, float]) -> tuple[DataFrame, bool]:
    """(name, goal), with goals that sum to 1 over the names there are, and whether names are few enough to broadcast."""
    own = cells.groupBy(dimension).agg(F.sum("n").alias("n"))
    if isinstance(target, dict):
        table = F.create_map(*[F.lit(x) for pair in target.items() for x in pair]) if target else F.lit(None).cast("map<string,double>")
        goal = F.coalesce(table[F.col(dimension)], F.lit(0.0))
    else:
        goal = F.pow(F.col("n").cast("double"), F.lit(float(target)))
    own = own.select(dimension, F.when(F.col("n") > 0, goal).otherwise(0.0).alias("goal"))
    whole, size = own.agg(F.sum("goal"), F.sum(F.octet_length(dimension) + 64)).first()
    return own.select(dimension, (F.col("goal") / F.lit(whole or 1.0)).alias(f"goal_{dimension}")), (size or 0) <= BROADCAST_BYTES


def _met(misfit: float, before: float, tolerance: float) -> bool:
    return misfit <= tolerance or misfit > STALLED * before


def _rake_few(cells: DataFrame, dimensions: list[str], tolerance: float) -> DataFrame:
    """The fit of cells that are known to be few, as arrays."""
    rows = cells.collect()
    share = np.array([float(r.n) for r in rows])
    codes = {d: np.unique([r[d] for r in rows], return_inverse=True)[1] for d in dimensions}
    goals = {}
    for d in dimensions:
        goals[d] = np.zeros(codes[d].max() + 1)
        goals[d][codes[d]] = [r[f"goal_{d}"] for r in rows]
    misfit, before = 0.0, np.inf
    while True:
        misfit, before = 0.0, misfit or before
        for d in dimensions:
            sums = np.bincount(codes[d], share)
            misfit = max(misfit, float(np.abs(sums - goals[d]).max()))
            share = share * np.divide(goals[d], sums, out=np.zeros(len(sums)), where=sums > 0)[codes[d]]
        if _met(misfit, before, tolerance):
            break
    table = [(*[r[d] for d in dimensions], r.n, float(x), misfit) for r, x in zip(rows, share)]
    fields = ", ".join(f"{d} string" for d in dimensions)
    return cells.sparkSession.createDataFrame(table, f"{fields}, n long, share double, misfit double")


def _rake_many(cells: DataFrame, dimensions: list[str], few: dict[str, bool], tolerance: float, folder: str) -> DataFrame:
    """The fit by steps over tables."""
    fixed = [*dimensions, "n", *[f"goal_{d}" for d in dimensions]]
    now = cells.select(*fixed, F.col("n").cast("double").alias("share"), *[F.lit(0.0).alias(f"gap_{d}") for d in dimensions])
    misfit, before, turn, tables = 0.0, float("inf"), 0, []
    while True:
        for d in dimensions:
            sums = now.groupBy(d).agg(F.sum("share").alias("sum"))
            goal = F.col(f"goal_{d}")
            scale = F.when(F.col("sum") > 0, goal / F.col("sum")).otherwise(0.0)
            gaps = [F.abs(F.col("sum") - goal).alias(f"gap_{x}") if x == d else f"gap_{x}" for x in dimensions]
            step = now.join(F.broadcast(sums) if few[d] else sums, d).select(*fixed, (F.col("share") * scale).alias("share"), *gaps)
            tables.append(f"{folder}/{turn}-{d}")
            now = written(step, "", tables[-1])
        misfit, before, turn = now.agg(F.max(F.greatest(*[f"gap_{d}" for d in dimensions], F.lit(0.0)))).first()[0] or 0.0, misfit or before, turn + 1
        if _met(misfit, before, tolerance):
            break
    dropped(cells.sparkSession, tables[:-1])
    return now.select(*dimensions, "n", "share", F.lit(float(misfit)).alias("misfit"))


def rake(cells: DataFrame, targets: dict, tolerance: float = TOLERANCE, few_cells: int = FEW_CELLS) -> DataFrame:
    """``cells`` (a column for each dimension of ``targets``, n) with ``share``, fitted to ``targets``, and ``misfit``."""
    dimensions = list(targets)
    folder = shared_folder(cells.sparkSession, "mixing")
    table = written(cells.select(*dimensions, "n"), "", f"{folder}/cells")
    now, few = table, {}
    for d in dimensions:
        goals, few[d] = _goals(table, d, targets[d])
        now = now.join(F.broadcast(goals) if few[d] else goals, d)
    now = written(now, "", f"{folder}/goals")
    n = now.count()
    if not n:
        return now.select(*dimensions, "n", F.lit(0.0).alias("share"), F.lit(0.0).alias("misfit"))
    return _rake_few(now, dimensions, tolerance) if n <= few_cells else _rake_many(now, dimensions, few, tolerance, folder)


def _weights(counted: DataFrame, targets: dict, keep: float) -> DataFrame:
    """(a column for each dimension, weight, probability, misfit) of each cell of ``counted`` (the dimensions, n_tokens)."""
    dimensions = list(targets)
    fitted = rake(counted.groupBy(*dimensions).agg(F.sum("n_tokens").alias("n")), targets)
    size = F.lit(64)
    for d in dimensions:
        size = size + F.octet_length(d)
    whole, size = fitted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(size), F.lit(0))).first()
    ratio = F.when(F.col("n") > 0, F.col("share") * F.lit(whole) / F.col("n")).otherwise(0.0)
    most = fitted.agg(F.max(ratio)).first()[0] or 1.0
    found = fitted.select(*dimensions, F.round(F.lit(keep) * ratio, 9).alias("weight"),
                          F.round(F.least(F.lit(float(keep)), F.lit(1.0) / F.lit(most)) * ratio, 9).alias("probability"), F.round("misfit", 9).alias("misfit"))
    return F.broadcast(found) if size <= BROADCAST_BYTES else found  # texts are not shuffled for a few cells


def _counted(docs: DataFrame, names: dict[str, Column] | None, *more: Column) -> DataFrame:
    return docs.select(*more, *_named(names), F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("n_tokens"))


def weights(docs: DataFrame, targets: dict | None = None, keep: float = KEEP, names: dict[str, Column] | None = None) -> DataFrame:
    """(source, lang, topic, weight, probability, misfit) of each cell."""
    return _weights(_counted(docs, names), targets or TARGETS, keep)


def chance(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 that the id alone decides."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("none")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def sampled(docs: DataFrame, targets: dict | None = None, keep: float = KEEP, names: dict[str, Column] | None = None) -> DataFrame:
    """For each row of ``docs``: doc_id, source, lang, topic, n_tokens, weight, probability, sampled, misfit."""
    targets = targets or TARGETS
    rows = written(_counted(docs, names, F.col("doc_id")), "counted")
    found = rows.join(_weights(rows, targets, keep), list(targets))
    return found.select("doc_id", *targets, "n_tokens", "weight", "probability", (chance(F.col("doc_id")) < F.col("probability")).alias("sampled"), "misfit")


def _weighted(docs: DataFrame, targets: dict | None, keep: float, names: dict[str, Column] | None) -> DataFrame:
    """(row, id, weight, probability) of each row of ``docs``."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), *_named(names))
    return rows.join(weights(docs, targets, keep, names), list(targets or TARGETS)).select("row", "id", "weight", "probability")


def mix(docs: DataFrame, targets: dict | None = None, keep: float = KEEP, names: dict[str, Column] | None = None) -> DataFrame:
    """The sampled rows of ``docs``, in its columns."""
    return _weighted(docs, targets, keep, names).where(chance(F.col("id")) < F.col("probability")).select("row.*")


def repeated(docs: DataFrame, targets: dict | None = None, keep: float = KEEP, names: dict[str, Column] | None = None) -> DataFrame:
    """The rows of ``docs``, in its columns, each in as many copies as its weight asks for."""
    whole = F.floor("weight")
    copies = (whole + (chance(F.col("id")) < F.col("weight") - whole).cast("int")).cast("int")
    rows = _weighted(docs, targets, keep, names)
    return rows.select("row", F.explode(F.array_repeat(F.lit(True), copies))).select("row.*")


#: Rounds of the SQL twin, which has no test of convergence: on its tables the fit is met in fewer.
SQL_ROUNDS = 16


def _oracle() -> str:
    parts = [rf"""
d AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  CASE WHEN regexp_matches(lower(t), '{LEGAL}') THEN 'legal'
  WHEN length(t) - length(replace(t, '|', '')) >= 5 THEN 'listing'
  WHEN len(regexp_extract_all(t, '[0-9]')) * 20 >= length(t) THEN 'data'
  WHEN length(t) < 600 THEN 'note' ELSE 'prose' END AS topic,
  CAST(len(regexp_extract_all(t, '{WORD}')) AS BIGINT) AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
c AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS n FROM d GROUP BY ALL),
r0 AS MATERIALIZED (SELECT *, CAST(n AS DOUBLE) AS share FROM c)"""]
    for d in DIMENSIONS:
        parts.append(f"""
goal_{d} AS MATERIALIZED (SELECT {d}, pow(CAST(sum(n) AS DOUBLE), {TARGETS[d]}) / sum(pow(CAST(sum(n) AS DOUBLE), {TARGETS[d]})) OVER () AS goal
  FROM c GROUP BY {d} HAVING sum(n) > 0)""")
    for k in range(SQL_ROUNDS * 3):
        d = DIMENSIONS[k % 3]
        parts.append(f"""
r{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN s.all_share > 0 THEN r.share * (coalesce(g.goal, 0.0) / s.all_share) ELSE 0.0 END AS share)
  FROM r{k} r JOIN (SELECT {d}, sum(share) AS all_share FROM r{k} GROUP BY {d}) s USING ({d}) LEFT JOIN goal_{d} g USING ({d}))""")
    last = f"r{SQL_ROUNDS * 3}"
    parts.append(f"""
v AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN n > 0 THEN share * (SELECT sum(n) FROM c) / n ELSE 0.0 END AS ratio FROM {last}),
w AS (SELECT source, lang, topic, round({KEEP} * ratio, 9) AS weight, round(least({KEEP}, 1.0 / (SELECT max(ratio) FROM v)) * ratio, 9) AS probability FROM v)""")
    misfit = "greatest(" + ", ".join(
        f"(SELECT max(abs(x - coalesce(goal, 0.0))) FROM (SELECT {d}, sum(share) AS x FROM {last} GROUP BY {d}) LEFT JOIN goal_{d} USING ({d}))" for d in DIMENSIONS) + ")"
    return "WITH" + ",".join(parts) + f"""
SELECT d.*, weight, probability,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'none') || ':{SEED}'), 1, 8)) AS BIGINT) / 4294967296.0 < probability AS sampled, round({misfit}, 9) AS misfit
FROM d JOIN w USING (source, lang, topic)"""


ORACLE_SQL = _oracle()
