"""Embedding whitening by shifted CholeskyQR.

Entries c become whole numbers x = floor(1024 c) + 100000, whose sums are
exact. Rows are centred by n x - S, exact in whole numbers, over n.

The centred rows A are orthogonalised without moving them: a distributed
pass sums the Gram matrix of A after triangular solves by all factors found
so far, and the driver takes its Cholesky factor as the next one. The first
Gram matrix is shifted by a multiple of its rounding error (so are later
ones that aren't positive definite), which keeps the factor from breaking
down. Passes go on until the Gram matrix is the identity to ``CLOSE``, at
most ``PASSES``. The last Gram matrix's root and the factors compose R, with
A = Q R: the singular values and right vectors of R are those of A, so
components and eigenvalues have the precision of A and not of its square.

A task holds a batch of rows and one Gram matrix; the driver holds matrices
of (entries x entries). Rows are never shuffled, so copies and frequent
vectors are like any others.

Defined cases: rows whose vector is NULL, empty, or holds a NULL or a
non-finite entry are dropped; 1024 c is held within 2^60; vectors of
different lengths raise ValueError; repeated rows count each; a NULL vec_id
stays; a component without variance has a NULL ``whitened``; ``deviation``
is NULL where it exceeds a long; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import written

SCALE, OFFSET, BOUND = 1024.0, 100_000, float(1 << 60)
COMPONENTS, PASSES, CLOSE = 8, 6, 1e-12
SLICE = 1 << 20  # entries that are worked on at once
LONG = (1 << 63) - 1


def whole_numbers(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vectors are whole."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    held = F.transform(v, lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(BOUND)), F.lit(-BOUND)))
    return (rows.where(v.isNotNull() & (F.size(v) > 0) & finite)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(held, lambda c: F.floor(c) + F.lit(OFFSET)).alias("x")))


def _matrices(batch: pa.RecordBatch, entries: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x) of slices of a batch."""
    step = max(1, SLICE // entries)
    for at in range(0, batch.num_rows, step):
        x = batch.column("x").slice(at, step)
        yield at, x.flatten().to_numpy().reshape(len(x), entries)


@dataclass
class Centre:
    """How many vectors there are, and the exact sums of their entries."""

    n: int
    sums: list[int]
    most: int  # the largest |x|

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly (as Python numbers where 64 bits could overflow)."""
        if self.n * self.most * 2 <= LONG:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def centre_of(vectors: DataFrame) -> Centre:
    """The sums, in two halves of 32 bits each, which tasks add up without overflow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, n, low, high, most = 0, 0, 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("x").value_lengths()
            entries = entries or sizes[0].as_py()
            if sizes.unique().to_pylist() != [entries]:
                entries, n = -1, 1  # told to the driver, which raises
                break
            for _, x in _matrices(batch, entries):
                n += len(x)
                low, high = low + (x & 0xFFFFFFFF).sum(axis=0), high + (x >> 32).sum(axis=0)
                most = max(most, int(np.abs(x).max()))
        if n:
            k = max(entries, 1)
            told = [np.arange(k), np.broadcast_to(low, k), np.broadcast_to(high, k), np.full(k, n), np.full(k, most), np.full(k, entries)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in told], ["entry", "low", "high", "n", "most", "entries"])

    parts = vectors.select("x").mapInArrow(run, "entry long, low long, high long, n long, most long, entries long")
    rows = parts.groupBy("entry").agg(F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum("n").alias("n"), F.max("most").alias("most"),
                                      F.min("entries").alias("least"), F.max("entries").alias("entries")).orderBy("entry").collect()
    if any(r.least != r.entries or r.least < 0 for r in rows):
        raise ValueError("vectors of different lengths")
    return Centre(rows[0].n, [(r.high << 32) + r.low for r in rows], max(r.most for r in rows)) if rows else Centre(0, [], 0)


def gram(vectors: DataFrame, centre: Centre, of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of outer products of ``of(centred row)``: a row for each entry and task is shuffled."""
    entries = len(centre.sums)
    at = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, x in _matrices(batch, entries):
                q = of(centre.centred(x))
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total[at])], ["i", "j", "v"])

    cells = vectors.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((width, width))
    for i, j, v in cells:
        out[i, j] = out[j, i] = v
    return out


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of the upper triangular ``factors``, in turn."""
    for r in factors:
        q = np.empty_like(rows)
        for j in range(r.shape[0]):
            q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        rows = q
    return rows


def _factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor of a Gram matrix, shifted by as little as it takes."""
    d = len(g)
    shift = 11 * (n * d + d * (d + 1)) * 2.0 ** -53 * np.linalg.norm(g, 2)
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d) * shifted).T
        except np.linalg.LinAlgError:
            shift, shifted = shift * (10 if shifted else 1), True


def upper_factor(vectors: DataFrame, centre: Centre) -> np.ndarray:
    """R with A = Q R for the centred rows A."""
    d, factors = len(centre.sums), []
    for turn in range(PASSES):
        g = gram(vectors, centre, lambda rows: solved(rows, factors), d)
        if turn == 0 and not g.any():
            return g
        if turn and np.abs(g - np.eye(d)).max() <= CLOSE:
            break
        if turn < PASSES - 1:
            factors.append(_factor(g, centre.n, shifted=turn == 0))
    # The last root: symmetric, so that rows without full rank have one as well.
    values, vectors_of = np.linalg.eigh(g)
    r = np.sqrt(np.maximum(values, 0.0))[:, None] * vectors_of.T
    for f in reversed(factors):
        r = r @ f
    return r


@dataclass
class Whitening:
    """``components`` (a column each), and for each its eigenvalue and share of the trace."""

    centre: Centre
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def scale(self) -> np.ndarray:
        return self.components / np.sqrt(np.where(self.values > 0, self.values, np.inf))


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The first ``k`` components of ``vectors`` (x); None if there are none."""
    centre = centre_of(vectors)
    if not centre.n:
        return None
    _, sigma, v = np.linalg.svd(upper_factor(vectors, centre))
    values = sigma ** 2 / centre.n
    values[sigma <= sigma[0] * 1e-13 * len(sigma)] = 0.0
    whole = values.sum()
    v = v[:k].T
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])  # the largest entry is positive
    return Whitening(centre, v, values[:k], values[:k] / whole if whole else np.zeros(len(values[:k])))


def identity_error(vectors: DataFrame, found: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity (components without variance left out)."""
    alive = found.values > 0
    scale = found.scale()[:, alive]
    if not alive.any():
        return 0.0
    cov = gram(vectors, found.centre, lambda rows: rows @ scale, scale.shape[1]) / found.centre.n
    return float(np.abs(cov - np.eye(len(cov))).max())


def _squares(deviations: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row."""
    fits = (deviations.astype(np.float64) ** 2).sum(axis=1) < 9.2e18
    out: list[int | None] = [None] * len(deviations)
    for i, s in zip(np.flatnonzero(fits).tolist(), (deviations[fits] ** 2).sum(axis=1).tolist()):
        out[i] = int(s)
    for i in np.flatnonzero(~fits).tolist():
        s = sum(int(x) ** 2 for x in deviations[i].tolist())
        out[i] = s if s <= LONG else None
    return out


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, found: Whitening, error: float) -> DataFrame:
    """A row for each of ``vectors`` (vec_id, x) and component."""
    k, entries = len(found.values), len(found.centre.sums)
    scale, alive = found.scale(), found.values > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _matrices(batch, entries):
                m = len(x)
                each = np.repeat(np.arange(m), k)
                w = (found.centre.centred(x) @ scale).ravel()
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").slice(at, m).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, found.centre.n)), pa.array(_squares(found.centre.deviations(x)), pa.int64()).take(pa.array(each)),
                    pa.array(w, pa.float64(), mask=np.tile(~alive, m)), pa.array(np.tile(found.explained, m)),
                    pa.array(np.full(m * k, error))], [c.split()[0] for c in OUT.split(", ")])

    return vectors.select("vec_id", "x").mapInArrow(run, OUT)


def whiten(rows: DataFrame, vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """For each row with a whole vector and each component up to ``k``: vec_id,
    component, n, deviation, whitened, explained, identity_error."""
    vectors = written(whole_numbers(rows, vector), "vectors")
    found = fit(vectors, k)
    if found is None:
        return rows.sparkSession.createDataFrame([], OUT)
    return whitened(vectors, found, identity_error(vectors, found))
