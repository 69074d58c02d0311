"""Removal of repeats against a brute-force version."""

import hashlib
import random
from collections import Counter

import pytest

from chronoledger.llm import suffix_dedup as S


def _brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _check(spark, rows, length=400, passage=None, **more):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, start int, tkey string").repartition(4)
    found = S.remove_repeats(docs, length, passage=passage, **more)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found.collect())
    want = sorted((str(d), *x) for (d, _), x in zip(rows, _brute([t for _, t in rows], length)))
    assert got == want
    repeated = sorted((str(d), x[1]) for (d, _), x in zip(rows, _brute([t for _, t in rows], passage or length)))
    assert sorted((str(r.doc_id), r.n_repeated) for r in found.collect()) == repeated
    return want


def _texts(seed, alphabet, size, length):
    rnd = random.Random(seed)

    def prose(n):
        return "".join(rnd.choice(alphabet) for _ in range(n))
    shared = [prose(rnd.randint(length - 3, 3 * length)) for _ in range(4)]
    texts = []
    for _ in range(size):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            s = rnd.choice(shared)
            a = rnd.randint(0, len(s) // 3)
            parts.append(rnd.choice((prose(rnd.randint(0, 2 * length)), s, s[a:], s[:len(s) - a], s[a:a + length], s[a:a + length - 1])))
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    texts = _texts(seed, ["a", "b", "é", "日", " "] if seed else ["a", "b"], 40, 64)
    rows = list(enumerate(texts)) + [(900, texts[0]), (None, texts[1]), (901, None), (902, ""), (5, "again"), (5, "again")]
    assert any(w[2] for w in _check(spark, rows, 64))


@pytest.mark.parametrize("seed", range(3))
def test_shorter_passages_are_counted_in_the_same_pass(spark, seed):
    texts = _texts(seed, ["a", "b", "é", "日", " "] if seed else ["a", "b"], 40, 64)
    rows = list(enumerate(texts)) + [(900, texts[0]), (901, texts[1][:50]), (902, texts[1][:50]), (903, "x" * 45), (904, "x" * 45), (905, "y" * 39), (906, "y" * 39)]
    _check(spark, rows, 64, passage=40)
    if seed == 2:
        _check(spark, rows, 64, passage=40, max_group=3)


def test_periodic_and_odd_texts(spark):
    rnd = random.Random(1)
    noise = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    texts = ["x" * 399, "x" * 400, "x" * 401, "y" * 1500, "ab" * 700, "abc" * 500 + "z", noise, noise[100:], noise[:499] + "!" + noise[500:], "é" * 450,
             noise[:399], "q" + noise[200:599], "w" + noise[200:600], "-" * 100 + noise[300:750] + "-" * 100]
    _check(spark, list(enumerate(texts)), passage=S.PASSAGE)


def test_large_groups_are_counted_by_window(spark):
    texts = _texts(9, "abcd ", 40, 64)
    rows = list(enumerate(texts))
    _check(spark, rows, 64, max_group=3)


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(10_000 + i, t[len(t) // 3:]) for i, (_, t) in enumerate(rows[:20])]
    rows += [(20_000 + i, f"{i} " * 20 + t[200:500] + f" {i}" * 20) for i, (_, t) in enumerate(rows[:20])]
    assert any(w[2] for w in _check(spark, rows, passage=S.PASSAGE))


def test_interval_tree():
    strings = sorted([b"banana", b"bandana", b"band", b"can", b"cant", b"ban"])
    common = [len(next(a for a in (x[:k] for k in range(9, -1, -1)) if y.startswith(a))) for x, y in zip(strings, strings[1:])]
    import numpy as np
    got = sorted(S.intervals(np.array(common)))
    want = sorted({(d, min(i for i, s in enumerate(strings) if s.startswith(p)), max(i for i, s in enumerate(strings) if s.startswith(p)))
                   for p, d in ((b"ban", 3), (b"band", 4), (b"can", 3))})
    assert got == want


def test_empty(spark):
    assert S.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
