"""Benchmark decontamination: BM25 over test items, searched by block-max WAND.

The index holds the test items; every passage of every training text is a
query against it. A passage is a window of twice ``step`` words, begun every
``step`` words, where ``step`` is over the longest item's length: each item
inside a text lies whole in some passage.

Weights are BM25's, divided by the item's score against itself, so a score
is the share of the item's own score that the passage reaches, and
``threshold`` is a share too. All items above it are retrieved:

* the blocks' greatest weights are summed for all passages of a text at
  once, and a passage in which no block of items can reach the threshold is
  passed over;
* other passages run block-max WAND: cursors over postings, a pivot by the
  terms' greatest weights, then by the greatest weights in the pivot's
  block, then the full score.

What is retrieved is verified: of the item's five-word shingles 0.8 or more
occur in the passage, and so do 0.8 or more of the words of its question and
of its answer (its last sentence, at least ``SHINGLE`` words).

The index is cut into shards of at most ``max_postings`` postings; each is
broadcast alone and all texts are matched against it. Document frequencies
and lengths are those of all items.

Defined cases: NULL texts are empty; items without words match nothing;
repeated items are one; an item of fewer than five words is one shingle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import ascii_lower, whole_text, written

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 4
MAX_POSTINGS = 2_000_000
MAX_SUMS = 1 << 20
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A-Z in lower case, all other ASCII but letters and digits as a space.
TABLE = bytes(ord(chr(i).lower()) if chr(i).isalnum() and i < 128 else i if i > 127 else 32 for i in range(256))
SENTENCE = re.compile(r"[.!?\n][\s\"')\]]+(?=\S)")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Item:
    """A test item's words, its shingles, and where its answer begins."""

    def __init__(self, item_id: int, text: str):
        self.item_id, self.words = item_id, words_of(text.encode())
        n, cut = len(self.words), 0
        for m in SENTENCE.finditer(text.rstrip()):
            cut = m.end()
        cut = min(len(words_of(text[:cut].encode())), n - SHINGLE)
        if n < 2 * SHINGLE or cut < SHINGLE:
            cut = n - max(SHINGLE, n // 4)
        self.question, self.answer = (self.words[:cut], self.words[cut:]) if cut >= SHINGLE else (self.words, self.words)
        self.shingles = _shingles(self.words)


def _shingles(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def _share(part: list[bytes], there: set[bytes]) -> float:
    return sum(w in there for w in part) / len(part)


class Index:
    """Postings of one shard, in blocks of ``BLOCK`` items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[bytes, int], n_items: int, mean_words: float):
        self.items = [Item(i, t) for i, t in items]
        self.terms: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.weights: list[list[float]] = []
        for at, item in enumerate(self.items):
            tf = Counter(item.words)
            room = K1 * (1 - B + B * len(item.words) / mean_words)
            w = {t: math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + room) for t, n in tf.items()}
            whole = sum(w.values())
            for t, x in w.items():
                k = self.terms.setdefault(t, len(self.terms))
                if k == len(self.ids):
                    self.ids.append([])
                    self.weights.append([])
                self.ids[k].append(at)
                self.weights[k].append(x / whole)
        self.most = [max(w) for w in self.weights]
        self.blocks = [{} for _ in self.ids]
        for best, ids, weights in zip(self.blocks, self.ids, self.weights):
            for i, w in zip(ids, weights):
                best[i // BLOCK] = max(best.get(i // BLOCK, 0.0), w)
        self.n_blocks = len(self.items) // BLOCK + 1
        self.block_count = np.array([len(b) for b in self.blocks] + [0], np.int64)
        self.block_start = np.cumsum(self.block_count) - self.block_count
        self.block_ids = np.array([i for b in self.blocks for i in b], np.int64)
        self.block_most = np.array([w for b in self.blocks for w in b.values()])
        self.step = math.ceil(1.25 * max((len(i.words) for i in self.items), default=1))

    def hopeful(self, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, list[int]]]:
        """(start, own terms) of the passages in which some block could reach the threshold."""
        windows = max(1, -(-len(terms) // self.step) - 1)
        most = max(1, MAX_SUMS // self.n_blocks)
        for first in range(0, windows, most):
            n = min(most, windows - first)
            part = terms[first * self.step:(first + n + 1) * self.step]
            half = np.arange(len(part)) // self.step
            key = np.unique(np.r_[half[half < n] * len(self.block_count) + part[half < n],
                                  (half[half > 0] - 1) * len(self.block_count) + part[half > 0]])
            window, term = np.divmod(key, len(self.block_count))
            count = self.block_count[term]
            total = int(count.sum())
            at = np.repeat(self.block_start[term] - np.cumsum(count) + count, count) + np.arange(total)
            sums = np.bincount(np.repeat(window, count) * self.n_blocks + self.block_ids[at], self.block_most[at],
                               n * self.n_blocks).reshape(n, self.n_blocks)
            for w in np.flatnonzero(sums.max(axis=1) >= threshold - 1e-9).tolist():
                own = term[np.searchsorted(window, w):np.searchsorted(window, w, "right")]
                yield (first + w) * self.step, own[own < len(self.terms)].tolist()

    def search(self, terms: list[int], threshold: float) -> Iterator[tuple[int, float]]:
        """(item, score) of all items that reach the threshold: block-max WAND."""
        ids, weights, most, blocks = self.ids, self.weights, self.most, self.blocks
        least = threshold - 1e-9
        cursors = [[ids[t][0], 0, t] for t in terms]

        def advance(c: list, to: int) -> None:
            own = ids[c[2]]
            c[1] = bisect_left(own, to, c[1])
            c[0] = own[c[1]] if c[1] < len(own) else math.inf

        while True:
            cursors.sort()
            bound, pivot = 0.0, -1
            for p, c in enumerate(cursors):
                if c[0] == math.inf:
                    break
                bound += most[c[2]]
                if bound >= least:
                    pivot = p
                    break
            if pivot < 0:
                return
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block, ahead = item // BLOCK, cursors[:pivot + 1]
            if sum(blocks[c[2]].get(block, 0.0) for c in ahead) >= least:
                if ahead[0][0] == item:
                    score = sum(weights[c[2]][c[1]] for c in ahead)
                    if score >= least:
                        yield item, score
                    for c in ahead:
                        advance(c, item + 1)
                else:
                    for c in ahead:
                        if c[0] < item:
                            advance(c, item)
            else:
                to = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                for c in ahead:
                    advance(c, to)

    def matches(self, text: bytes, threshold: float) -> dict[int, tuple[float, float, float, float]]:
        """Verified items in a text: item -> best (score, overlap, question's, answer's)."""
        words = words_of(text)
        if not words or not self.items:
            return {}
        terms = np.fromiter(map(self.terms.get, words, repeat(len(self.terms))), np.int64, len(words))
        found: dict[int, tuple[float, float, float, float]] = {}
        for at, own in self.hopeful(terms, threshold):
            window = slice(at, at + 2 * self.step)
            here = shingles = None
            for i, score in self.search(own, threshold):
                if here is None:
                    here, shingles = set(words[window]), _shingles(words[window])
                item = self.items[i]
                overlap = len(item.shingles & shingles) / len(item.shingles)
                if overlap < OVERLAP and len(item.words) >= SHINGLE:
                    continue
                if len(item.words) < SHINGLE:
                    overlap = float(b" " + b" ".join(item.words) + b" " in b" " + b" ".join(words[window]) + b" ")
                shares = _share(item.question, here), _share(item.answer, here)
                if overlap >= OVERLAP and min(shares) >= OVERLAP:
                    found[i] = max(found.get(i, (0.0,) * 4), (score, overlap, *shares))
        return found


def shards(benchmark: DataFrame, max_postings: int = MAX_POSTINGS) -> Iterator[Index]:
    """Indexes of at most about ``max_postings`` postings that hold all items together."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), whole_text().alias("text")).distinct()
    items = items.withColumn("ws", F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORDS), F.lit(0))).where(F.size("ws") > 0)
    terms = F.array_distinct("ws")
    n, words, postings = items.agg(F.count(F.lit(1)), F.sum(F.size("ws")), F.sum(F.size(terms))).first()
    if not n:
        return
    df = items.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    parts = -(-postings // max_postings)
    for k in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        there = own.select(F.explode("ws").alias("term")).distinct()
        counts = df if parts == 1 else df.join(there, "term", "left_semi")
        yield Index([(r.item_id, r.text) for r in own.select("item_id", "text").orderBy("item_id", "text").collect()],
                    {r.term.encode(): r.df for r in counts.collect()}, n, words / n)


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[Column] | None = None, threshold: float = THRESHOLD,
                 max_postings: int = MAX_POSTINGS) -> DataFrame:
    """Verified pairs: the ``keep`` columns (default ``doc_id``), item_id,
    score, overlap, question_overlap, answer_overlap."""
    rows = docs.select(*(keep or [F.col("doc_id")]), whole_text().cast("binary").alias("__text"))
    names = [c for c in rows.columns if c != "__text"]
    out = rows.drop("__text").schema.add("item_id", "long")
    measures = ["score", "overlap", "question_overlap", "answer_overlap"]
    for c in measures:
        out = out.add(c, "double")
    found = docs.sparkSession.createDataFrame([], out)
    for index in shards(benchmark, max_postings):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                at, items, values = [], [], []
                for i, text in enumerate(batch.column("__text").to_pylist()):
                    for item, measured in own.matches(text, threshold).items():
                        at.append(i)
                        items.append(own.items[item].item_id)
                        values.append([round(x, 6) for x in measured])
                columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in names]
                columns.append(pa.array(items, pa.int64()))
                columns += [pa.array([v[k] for v in values], pa.float64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "item_id", *measures])

        found = found.unionByName(rows.mapInArrow(run, out))
    return found.groupBy(*names, "item_id").agg(*[F.max(c).alias(c) for c in measures])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no test item was found."""
    content = F.xxhash64(whole_text())
    bad = written(contaminated(docs, benchmark, [F.col("doc_id").alias("id"), content.alias("content")])
                  .select("id", "content").distinct(), "contaminated")
    here = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), content.alias("content"))
    return here.alias("h").join(bad.alias("b"), F.col("h.id").eqNullSafe(F.col("b.id"))
                                & (F.col("h.content") == F.col("b.content")), "left_anti").select("h.row.*")
