"""Raking and sampling against a brute-force version."""

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from chronoledger.llm import mixing as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, weight double, topic string"


def _docs(spark, n=400, seed=2):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = rnd.choice((3, 40, 400))
        text = " ".join(rnd.choice(("some", "words", "a|b", "12", "License")) for _ in range(words))
        rows.append((i, text, rnd.choice(("en", "en", "fr", None)), rnd.choice(("s0", "s0", "s0", "s1", "s2")), 0, 9.0, "x"))
    return spark.createDataFrame(rows, SCHEMA)


def test_marginals_are_met(spark):
    cells = spark.createDataFrame([(s, l, t, 10 + 7 * i * j + 3 * k * k) for i, s in enumerate("abc") for j, l in enumerate("de")
                                   for k, t in enumerate("fgh")], "source string, lang string, topic string, n long")
    goals = {"source": {"a": .5, "b": .3, "c": .2}, "lang": {"d": .4, "e": .6}, "topic": {"f": .2, "g": .2, "h": .6}}
    rows = M.rake(cells, goals).collect()
    for d, goal in goals.items():
        for name, share in goal.items():
            assert sum(r.share for r in rows if r[d] == name) == pytest.approx(share, abs=1e-6)
    cell = {(r.source, r.lang, r.topic): r.share / r.n for r in rows}
    for a, b in (("d", "e"),):  # what raking keeps: the cross ratios of the start
        odds = [cell["a", a, t] * cell["b", b, t] / cell["a", b, t] / cell["b", a, t] for t in "fgh"]
        assert odds == pytest.approx([1, 1, 1])


def _fit(cells, goals, rounds):
    share = {c: float(n) for c, n in cells.items()}
    for _ in range(rounds):
        for k, d in enumerate(M.DIMENSIONS):
            sums = {}
            for c, x in share.items():
                sums[c[k]] = sums.get(c[k], 0.0) + x
            share = {c: x * goals[d].get(c[k], 0.0) / sums[c[k]] if sums[c[k]] else 0.0 for c, x in share.items()}
    return share


def test_sample_is_that_of_brute_force(spark):
    docs = _docs(spark)
    rows = M.sampled(docs).collect()
    cells = {}
    for r in rows:
        cells[r.source, r.lang, r.topic] = cells.get((r.source, r.lang, r.topic), 0) + r.n_tokens
    goals = {}
    for k, d in enumerate(M.DIMENSIONS):
        own = {}
        for c, n in cells.items():
            own[c[k]] = own.get(c[k], 0) + n
        power = {x: n ** M.TARGETS[d] for x, n in own.items() if n}
        goals[d] = {x: n / sum(power.values()) for x, n in power.items()}
    share = _fit(cells, goals, 40)
    whole = sum(cells.values())
    most = max(share[c] * whole / n for c, n in cells.items() if n)
    for r in rows:
        c = (r.source, r.lang, r.topic)
        weight = M.KEEP * share[c] * whole / cells[c]
        assert r.weight == pytest.approx(weight, abs=2e-9) and r.misfit == 0
        assert r.probability == pytest.approx(weight / M.KEEP * min(M.KEEP, 1 / most), abs=2e-9)
        u = int(hashlib.md5(f"{r.doc_id}:{M.SEED}".encode()).hexdigest()[:8], 16) / 2 ** 32
        assert r.sampled == (u < r.probability)
    assert len(rows) == docs.count()
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in rows if r.sampled)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1.0, "t"), (2, "a b", "en", "s", 3, 1.0, "t"), (2, "a b", "en", "s", 3, 1.0, "t")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.sampled(docs).collect()
    assert len(got) == 4 and {r.source for r in got} == {"(none)", "s"}
    assert next(r for r in got if r.doc_id is None).weight == 0.0
    two = [r.sampled for r in got if r.doc_id == 2]
    assert two[0] == two[1]
    assert M.sampled(docs.where("false")).count() == 0 and M.mix(docs.where("false")).count() == 0


def test_explicit_targets_drop_names_without_one(spark):
    docs = _docs(spark, 200)
    targets = {"source": {"s0": 1.0}, "lang": 1.0, "topic": 1.0}
    assert {r.source for r in M.sampled(docs, targets).where("sampled").collect()} == {"s0"}


def _skewed(spark):
    """40-token notes; one in 25 of a source, and one in 50 of a language, that the targets lift."""
    text = " ".join(["word"] * 40)
    return spark.createDataFrame([(i, text, "fr" if i % 50 < 1 else "en", "rare" if i % 25 == 3 else "s0", 0, 9.0, "x") for i in range(6000)], SCHEMA)


def test_copies_follow_the_weights(spark):
    docs = _skewed(spark)
    want = Counter()
    for r in M.sampled(docs).collect():
        u = int(hashlib.md5(f"{r.doc_id}:{M.SEED}".encode()).hexdigest()[:8], 16) / 2 ** 32
        want[r.doc_id] = int(r.weight) + (u < r.weight % 1)
        assert r.probability <= 1 and r.sampled == (u < r.probability)
    got = M.repeated(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == +want and max(want.values()) > 2


def test_pipeline_stage_meets_the_marginals(spark):
    docs = _skewed(spark)
    rows = corpus_pipeline.mixing_to_weights(spark, docs, "").collect()
    for d in ("source", "lang"):
        own = Counter(r[d] for r in docs.collect())
        power = {x: n ** M.TARGETS[d] for x, n in own.items()}
        got = Counter(r[d] for r in rows)
        for x in own:
            assert got[x] / len(rows) == pytest.approx(power[x] / sum(power.values()), rel=0.1), (d, x)
    assert len(rows) == pytest.approx(M.KEEP * 6000, rel=0.03)


def test_repeated_odd_rows(spark):
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1.0, "t"), (2, "a b", "en", "s", 3, 1.0, "t")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert Counter(r.doc_id for r in M.repeated(docs, keep=3.0).collect()) == {2: 3}
    assert M.repeated(docs.where("false")).count() == 0


def _expected(rows, d):
    """Shares of the tokens expected of the sample, by name."""
    kept = Counter()
    for r in rows:
        kept[r[d]] += r.probability * r.n_tokens
    return {x: n / sum(kept.values()) for x, n in kept.items()}


@pytest.mark.parametrize("made", [_skewed, _docs])
def test_probabilities_are_calibrated(spark, made):
    """No probability is above 1, and the sums expected of the sample are the targets', at the production setting."""
    rows = M.sampled(made(spark)).collect()
    assert max(r.probability for r in rows) <= 1 and {r.misfit for r in rows} == {0.0}
    if made is _skewed:
        assert max(r.weight for r in rows) > 1 and max(r.probability for r in rows) == 1
    for d in M.DIMENSIONS:
        own = Counter()
        for r in rows:
            own[r[d]] += r.n_tokens
        power = {x: n ** M.TARGETS[d] for x, n in own.items()}
        for x, share in _expected(rows, d).items():
            assert share == pytest.approx(power[x] / sum(power.values()), abs=1e-6)


def test_tied_dimensions(spark):
    """Sources that hold nearly one language each need many rounds; the fit goes on until the sums are met."""
    n = {("a", "x"): 5000, ("a", "y"): 40, ("b", "x"): 30, ("b", "y"): 900, ("c", "y"): 70, ("c", "x"): 700}
    cells = spark.createDataFrame([(s, l, t, k * (i + 1)) for (s, l), k in n.items() for i, t in enumerate("fg")], "source string, lang string, topic string, n long")
    goals = {"source": {"a": .3, "b": .5, "c": .2}, "lang": {"x": .35, "y": .65}, "topic": {"f": .5, "g": .5}}
    rows = M.rake(cells, goals).collect()
    assert rows[0].misfit <= M.TOLERANCE
    tables = M.rake(cells, goals, tolerance=1e-3, few_cells=0).collect()
    arrays = {tuple(r[:4]): r.share for r in M.rake(cells, goals, tolerance=1e-3).collect()}
    assert {tuple(r[:4]): r.share for r in tables} == pytest.approx(arrays, rel=1e-9) and 0 < tables[0].misfit <= 1e-3
    for d, goal in goals.items():
        for name, share in goal.items():
            assert sum(r.share for r in rows if r[d] == name) == pytest.approx(share, abs=1e-11)


def test_goals_that_exclude_each_other_are_told(spark):
    cells = spark.createDataFrame([("a", "x", "f", 10), ("b", "y", "f", 90)], "source string, lang string, topic string, n long")
    rows = M.rake(cells, {"source": {"a": .5, "b": .5}, "lang": {"x": .2, "y": .8}, "topic": 1.0}).collect()
    assert rows[0].misfit == pytest.approx(0.3)


def test_dimensions_of_the_caller(spark, monkeypatch):
    from pyspark.sql import functions as F

    rake = M.rake

    monkeypatch.setattr(M, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(M, "rake", lambda *a: rake(*a, few_cells=0))
    docs = _docs(spark, 100)
    rows = M.sampled(docs, targets={"kind": {"0": .5, "1": .5}}, names={"kind": F.col("doc_id") % 2}, keep=0.2).collect()
    assert len(rows) == 100 and _expected(rows, "kind") == pytest.approx({"0": .5, "1": .5})


def test_texts_are_not_shuffled_for_a_few_cells(spark):
    plan = M.repeated(_docs(spark, 50))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
