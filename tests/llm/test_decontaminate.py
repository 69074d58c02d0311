"""Benchmark decontamination against a brute-force version."""

import math
import random
import re
from collections import Counter

import pytest

from chronoledger.llm import decontaminate as D


def _words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _scores(passage, items):
    """BM25 of every item for a passage, as a share of the item's own score."""
    n, mean = len(items), sum(len(i) for i in items) / len(items)
    df = Counter(w for i in items for w in set(i))

    def bm25(query, item):
        tf = Counter(item)
        return sum(math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (.25 + .75 * len(item) / mean))
                   for w in set(query) if w in tf)
    return [bm25(passage, i) / bm25(i, i) for i in items]


def _index(items):
    df = Counter(w.encode() for t in items for w in set(_words(t)))
    return D.Index(list(enumerate(items)), df, len(items), sum(len(_words(t)) for t in items) / len(items))


@pytest.mark.parametrize("seed", range(4))
def test_wand_retrieves_all_above_the_threshold(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rnd.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=rnd.randint(3, 30))) for _ in range(150)]
    index = _index(items)
    for _ in range(60):
        passage = rnd.choices(vocabulary, k=rnd.randint(1, 60))
        threshold = rnd.choice((0.3, 0.5, 0.7))
        terms = [index.terms[w.encode()] for w in set(passage) if w.encode() in index.terms]
        got = dict(index.search(terms, threshold))
        want = {i: s for i, s in enumerate(_scores(passage, [_words(t) for t in items])) if s >= threshold - 1e-9}
        assert got.keys() == want.keys()
        assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def _held(text, item):
    """Share of the item's five-word shingles in the whole text."""
    words, own = _words(text), _words(item)

    def grams(ws):
        return {tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))}
    if len(own) < 5:
        return float(any(words[i:i + len(own)] == own for i in range(len(words) - len(own) + 1)))
    return len(grams(own) & grams(words)) / len(grams(own))


def test_whole_tables(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = bench.collect()
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items if _held(d.text, i.text) >= 0.8}
    assert want
    for postings in (D.MAX_POSTINGS, 300):
        rows = D.contaminated(docs, bench, max_postings=postings).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
    left = D.clean(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d.doc_id for d in docs.collect()} - {d for d, _ in want}


def test_planted_and_odd_rows(spark):
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(3000)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, f"{prose(20)}. {prose(8)}.") for i in range(50)] + [(50, "tiny item"), (51, None), (52, ""), (0, None)]
    items += [items[3]]
    texts = {i: prose(rnd.choice((5, 300, 2000))) for i in range(60)}
    texts[1] = texts[1] + "\n### " + items[4][1].upper() + "$$$ " + prose(30)
    texts[2] = prose(1000) + " " + items[5][1] + " " + items[6][1]
    changed = items[7][1].split()
    changed[0] = "other"
    texts[3] = prose(100) + " " + " ".join(changed)
    texts[4] = items[8][1][:60]
    texts[5] = "a tiny, item!"
    texts[6], texts[7] = None, ""
    rows = [(d, t, 0.0, "x") for d, t in texts.items()] + [(None, items[9][1], 0.0, "x"), (2, texts[2], 0.0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert got == {(1, 4), (2, 5), (2, 6), (3, 7), (5, 50), (None, 9)}
    assert D.clean(docs, bench).count() == len(rows) - 6
    assert D.contaminated(docs, bench.where("false")).count() == 0
    assert D.contaminated(docs.where("false"), bench).count() == 0
