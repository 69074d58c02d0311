"""SimHash groups against a brute-force version."""

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from chronoledger.llm import simhash


def _fingerprint(text, k=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _groups(fps, d):
    """Index of the first row that can be reached from each row."""
    values = np.array(fps, np.uint64)
    label = list(range(len(fps)))
    for start in range(len(fps)):
        if label[start] != start:
            continue
        todo, seen = [start], {start}
        while todo:
            x = todo.pop()
            for y in np.flatnonzero(np.bitwise_count(values ^ values[x]) <= d).tolist():
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        for y in seen:
            label[y] = min(label[y], start)
    return label


def _check(rows, texts):
    fps = [_fingerprint(t) for _, t in texts]
    label = _groups(fps, 4)
    ids = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            ids[label[i]] = min(ids.get(label[i], doc), doc)
    want = sorted((str(doc), f"{fps[i]:016x}", str(ids.get(label[i]))) for i, (doc, _) in enumerate(texts))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want


def _texts():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice((3, 40, 200, 400)))] for _ in range(60)]
    texts = []
    for words in base:
        for _ in range(rnd.choice((1, 1, 4))):
            copy = list(words)
            for _ in range(rnd.choice((0, 0, 1, 2))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy).title() if rnd.random() < 0.2 else "\t".join(copy))
    texts += [None, "", " \n", "one", "one two three four", "One Two Three", "É é", "x" * 5000, "a " * 30000]
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, "one"), (7, None), (7, None)]


def test_matches_brute_force(spark):
    texts = _texts()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in texts], "doc_id long, text string, fp string, root int")
    _check(simhash.near_duplicates(docs.repartition(5)).collect(), texts)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    _check(simhash.near_duplicates(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_split_cells_and_near_copies(spark):
    rnd = random.Random(1)
    centre = rnd.getrandbits(64)
    fps = {centre} | {centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(600)}
    fps |= {rnd.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    label = _groups(fps, 4)
    for cap in (1 << 16, 40):
        links = [(r.a, r.b) for r in simhash.links(frame, max_cell=cap).collect()]
        at = {f: i for i, f in enumerate(signed)}
        assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 for a, b in links)
        parent = list(range(len(fps)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in links:
            parent[max(root(at[a]), root(at[b]))] = min(root(at[a]), root(at[b]))
        assert [root(i) for i in range(len(fps))] == label


def _signed(fps):
    return [f - (1 << 64) if f >> 63 else f for f in fps]


def _top_bit_pairs():
    """Isolated pairs at distance 2 and 4 that differ in bit 63 and each other bit."""
    rnd, pairs = random.Random(9), []
    for b in range(63):
        more = rnd.sample([x for x in range(63) if x != b], 2)
        for bits in ([b, 63], [b, 63, *more]):
            x = rnd.getrandbits(64)
            pairs.append((x, x ^ sum(1 << y for y in bits)))
    return pairs


def test_pairs_that_differ_in_the_top_bit_are_linked(spark):
    pairs = _top_bit_pairs()
    frame = spark.createDataFrame([(f,) for f in _signed([f for p in pairs for f in p])], "fp long")
    got = {frozenset((r.a, r.b)) for r in simhash.links(frame).collect()}
    assert got == {frozenset(_signed(p)) for p in pairs}


@pytest.mark.parametrize("others", [0, 100])
def test_top_bit_within_small_and_large_cells(others):
    rnd = random.Random(10)
    fill = [rnd.getrandbits(64) for _ in range(others)]
    for pair in _top_bit_pairs():
        fps = np.array(_signed([pair[0], *fill, pair[1]]), np.int64)
        bits = fps.view(np.uint64)
        high, low = bits >> np.uint64(1), np.uint64(simhash.LOW_BITS)
        u = ((bits & high & low) << np.uint64(1) | (bits | high) & low).view(np.int64)
        cell = pd.DataFrame({"t": np.zeros(len(fps), np.int64), "fp": fps, "u": u})
        (found,) = simhash._cell_links(["t"], 4)(iter([cell]))
        assert [set(x) for x in found.to_numpy().tolist()] == [set(_signed(pair))]


def test_one_of_each_keeps_one_row_and_all_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e", "p"), (1, "a b c d e", "p"), (2, "A b c d e", "q"), (3, "z y x w v", None), (None, "a b c d e", "r"), (4, None, "s"), (5, "", "t")],
        "doc_id long, text string, content string")
    rows = simhash.one_of_each(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.content) for r in rows] == [(1, "p"), (3, None), (4, "s")]
    assert simhash.one_of_each(docs).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs.withColumn("lang", F.lit("en"))).count() == 0
