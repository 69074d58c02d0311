"""Huffman files: optimal lengths, exact round trips, ids as the library gives them."""

import heapq
import random
import zlib

import numpy as np
import pytest

from chronoledger.llm import token_output as T

VOCABULARY = "word_bpe_49k.json"


def _library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def _huffman_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    return cost


@pytest.mark.parametrize("seed", range(6))
def test_lengths_are_optimal_and_limited(seed):
    rnd = random.Random(seed)
    counts = np.array([rnd.randint(1, 10 ** rnd.randint(1, 4)) for _ in range(rnd.randint(2, 300))])
    free = T.code_lengths(counts, 40)
    assert (counts * free).sum() == _huffman_cost(counts.tolist())
    limit = int(np.ceil(np.log2(len(counts)))) + 1
    tight = T.code_lengths(counts, limit)
    assert tight.max() <= limit and sum(2.0 ** -tight) <= 1


def test_limited_code_beats_all_others_on_a_small_alphabet():
    from itertools import product
    counts = np.array([1, 1, 2, 5, 13, 40])
    best = min(sum(c * n for c, n in zip(counts, ls)) for ls in product(range(1, 4), repeat=6) if sum(2.0 ** -n for n in ls) <= 1)
    assert (counts * T.code_lengths(counts, 3)).sum() == best


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
def test_block_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = np.minimum(rnd.zipf(1.3, n), 3000).astype(np.uint32) * 7
    symbols, counts = np.unique(ids, return_counts=True)
    book = T.Book(symbols.astype(np.int64), T.code_lengths(counts))
    payload, checkpoints = book.encode(ids)
    assert (book.decode(payload, checkpoints, n) == ids).all()


def test_files_hold_the_librarys_ids(spark, sf):
    library = _library()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    odd = [None, "", "  \n", "<|endoftext|> x<|startoftext|>y", "don't we'll x's 'S", "áb é. ́x", "ΑΣ Σ", "½² 12x _a_",
           "a b c\x1cd\x85e", "हिन्दी क़ 日本語。テスト", "x" * 3000, "word " * 20000, "A,b;c...", "İstanbul ſtraße K", "가"]
    rows += [(100_000 + 3 * i, t) for i, t in enumerate(odd)] + [(5, "again"), (5, "again"), (None, "none")]
    docs = spark.createDataFrame([(d, t, "z", 0) for d, t in rows], "doc_id long, text string, ids string, shard int").repartition(7)
    got = T.digests(docs).collect()
    want = {}
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), *x) for d, xs in want.items() for x in xs)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_empty(spark):
    assert T.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
