from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoledger.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """{(vec_id, component): (n, deviation, whitened, explained)} by exact covariances and a symmetric eigen-solver."""
    kept = [(i, [int(np.floor(1024 * np.float64(np.float32(c)))) + 100000 for c in v]) for i, v, _ in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[j] for _, x in kept) for j in range(d)]
    dev = [[n * x[j] - sums[j] for j in range(d)] for _, x in kept]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in dev), n ** 3)) for j in range(d)] for i in range(d)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    out = {}
    for (i, _), r in zip(kept, dev):
        w = np.array([float(Fraction(a, n)) for a in r]) @ v
        for k in range(min(8, d)):
            out.setdefault((i, k + 1), []).append((n, sum(a * a for a in r), w[k] / np.sqrt(e[k]), e[k] / e.sum()))
    return out


def check(got, rows):
    want = brute(rows)
    signs = {}
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        n, deviation, w, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - w) <= abs(r.whitened + w) else -1) if abs(w) > 1e-6 else signs.get(r.component, 1)
        assert r.whitened * sign == pytest.approx(w, rel=1e-9, abs=1e-9)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-9


@pytest.mark.parametrize("condition", [1.0, 1e-2])
def test_brute_force(spark, condition):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 12)) * np.geomspace(1, condition, 12) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(base)]
    rows += [(300 + i, rows[0][1], None) for i in range(100)]  # a frequent vector
    rows += [(None, rows[1][1], 1), (900, None, 0), (901, [], 0), (902, [None] * 12, 0), (903, [float("nan")] + [0.0] * 11, 0), (904, [float("inf")] + [0.0] * 11, 0)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    check(got, rows)


def test_query_on_given_table(spark):
    got = queries.op13_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(got, rows)


def test_dependent_entries(spark):
    """Fewer dimensions than entries: components without variance say so."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b), float(a), 0.5], 0) for i, (a, b) in enumerate(rng.integers(-3, 4, size=(60, 2)))]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 240 and {r.component for r in got if r.whitened is None} == {3, 4}
    assert all(r.identity_error < 1e-9 and (r.explained == 0) == (r.component > 2) for r in got)


def test_no_variance_and_empty(spark):
    same = spark.createDataFrame([(1, [0.5, 0.25], 0), (1, [0.5, 0.25], 0)], SCHEMA)
    got = whitening.whiten(same).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(2, 0, None, 0.0, 0.0)] * 4
    none = whitening.whiten(same.where("vec_id > 5"))
    assert none.count() == 0 and none.columns == [c.split()[0] for c in whitening.OUT.split(", ")]


def test_large_numbers_are_exact(spark):
    rows = [(1, [1e30, 0.0], 0), (2, [0.0, 1.0], 0), (3, [-1e30, 2.0], 0), (4, [1e9, 2.0], 0)]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA), k=1).collect()}
    x = [[int(max(min(1024 * np.float64(np.float32(c)), 2.0 ** 60), -2.0 ** 60)) + 100000 for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x)]
    for (i, _, _), v in zip(rows, x):
        want = sum((4 * a - b) ** 2 for a, b in zip(v, s))
        assert got[i].deviation == (want if want < 1 << 63 else None)


def test_lengths_that_differ_are_refused(spark):
    with pytest.raises(ValueError, match="different lengths"):
        whitening.whiten(spark.createDataFrame([(1, [0.5], 0), (2, [0.5, 0.25], 0)], SCHEMA).coalesce(1))


def test_extra_columns(spark):
    rows = [(i, [float(i), float(i * i % 7)], 0) for i in range(9)]
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("x", "n", "component", "whitened", "deviation", "i", "j", "v")])
    check(whitening.whiten(wide).collect(), rows)
