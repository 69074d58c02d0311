"""Spelling variants: words one edit apart, by k-d trees over letter counts.

One inserted, deleted or replaced letter moves the vector of a word's letter
counts by an L1 distance of at most two: one up, and, if lengths are equal,
one down. So for each pair of lengths (l, l) and (l, l + 1) the words of the
second length stand in k-d trees and those of the first are range queries:
nodes whose box is farther than that are pruned (by bits: counts and boxes
stand as codes), and what is left is verified letter by letter. Of two words of one length the one with the smaller
``rank`` of its letters asks, and nodes without a larger one are pruned.

Words are dealt to cells by length and by the leaves of a top tree. That
tree is fitted on a bounded sample of the words (the ``SAMPLE`` with the
least hash; at most ``SAMPLE / LEAST_LEAF`` leaves), but places every word,
and a query goes to every leaf whose box it can reach, so the sample decides
balance and not results. A cell that is still too large is cut in parts by
hash (its queries go to each part), and one with many queries is repeated
for shares of them, so a length that holds a third of all words is many
tasks' work. A task holds the tree of one part and streams the queries.

Corpus work is one pass of built-in functions, with partial counts before
the shuffle; everything after it works on distinct words. Roots are found by
doubling the links from word to form, a written table a round.

Defined cases: a NULL text has no words; a NULL doc_id is hashed as
``none``; rows that repeat count again; an empty table gives an empty
result. Words of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import ascii_lower, dropped, shared_folder, whole_text, written

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT, DAMAGE = 5, 3, 97
SAMPLE, LEAST_LEAF = 20_000, 16
CELL_BYTES, CELL_QUERIES = 64 << 20, 120_000
TREE_LEAF, STEPS, TOGETHER = 256, 32, 30_000
DIMENSIONS = 26 + 64
WORK = 1 << 18  # numbers compared at once
BATCH = 1 << 12  # pairs given out at once

#: The dimension of each letter, by its code.
_DIMENSION = np.zeros(256, np.int64)
_DIMENSION[ord("a"):ord("z") + 1] = np.arange(26)
_DIMENSION[0xC0:0x100] = 26 + np.arange(64)


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all words, of which the hash of id and run says which lose a letter."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")).alias("id"),
                       F.explode(F.regexp_extract_all(ascii_lower(whole_text()), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    rows = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % damage == 0, less).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least_count))


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letter codes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def counts(letters: np.ndarray) -> np.ndarray:
    """The letter counts of each row. Those past 32,000 are held there, which
    moves no two rows apart."""
    out = np.empty((len(letters), DIMENSIONS), np.int16)
    step = max(1, 8 * WORK // max(letters.shape[1], DIMENSIONS))  # bincount takes eight bytes a cell
    for at in range(0, len(letters), step):
        some = letters[at:at + step]
        n = len(some)
        cells = _DIMENSION[some] + np.arange(n)[:, None] * DIMENSIONS
        out[at:at + n] = np.minimum(np.bincount(cells.ravel(), minlength=n * DIMENSIONS), 32_000).reshape(n, DIMENSIONS)
    return out


def _split(rows: np.ndarray) -> tuple[int, int] | None:
    """The dimension of the largest variance and a median: rows go left up to it. None where all are equal."""
    spread = rows.astype(np.float32).var(axis=0)
    d = int(spread.argmax())
    if not spread[d]:
        return None
    t = int(np.median(rows[:, d]))
    return d, t if (rows[:, d] > t).any() else t - 1


def rank(rows: np.ndarray) -> np.ndarray:
    """The sum of the dimensions of each row's letters: replacing a letter always changes it."""
    return rows.astype(np.int64) @ np.arange(DIMENSIONS)


def _bits(codes: np.ndarray) -> np.ndarray:
    """The bits set in each column."""
    return np.bitwise_count(codes).sum(axis=0, dtype=np.uint16)


def _thresholds(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dimensions, thresholds) of the bits of codes, those that halve the
    rows best first: each value below the largest that a dimension has, or
    at most ``STEPS`` quantiles where those are more."""
    found = []
    for d in np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)):
        values = np.sort(rows[:, d])
        steps = np.arange(values[0], values[-1]) if values[-1] - values[0] <= STEPS else np.unique(values[np.arange(STEPS) * len(values) // STEPS])
        steps = steps[steps < values[-1]]
        above = len(values) - np.searchsorted(values, steps, "right")
        found += [(abs(2 * int(n) - len(values)), d, int(t)) for n, t in zip(above, steps)]
    found.sort()
    return np.array([d for _, d, _ in found], np.int64), np.array([t for _, _, t in found], np.int64)


class Tree:
    """A k-d tree over rows of counts, with the tight box of each node.

    Rows and boxes stand as codes: a bit for each dimension and threshold,
    set where the count is larger. The lower corner of a box is the AND of
    its rows' codes, the upper one their OR, and the bits that one code has
    and another lacks are at most the letters that it has more (as many, if
    every value is a threshold), so nothing near is lost. What a query
    counts outside of the box of all rows is taken off its allowance first.
    Arrays are (words of 64 bits x rows)."""

    def __init__(self, rows: np.ndarray, leaf: int = TREE_LEAF):
        self.low, self.high = rows.min(axis=0), rows.max(axis=0)
        self.dimensions, self.thresholds = _thresholds(rows)
        self.boxes, self.children, self.members = [], [], []
        todo = [(np.arange(len(rows)), -1)]
        ranks, codes = rank(rows), self._codes(rows)
        rows = np.ascontiguousarray(rows[:, self.high > self.low])
        while todo:
            members, parent = todo.pop()
            own, node = codes[:, members], len(self.boxes)
            self.boxes.append((np.bitwise_and.reduce(own, axis=1), np.bitwise_or.reduce(own, axis=1), int(ranks[members].max())))
            self.children.append([])
            self.members.append(None)
            if parent >= 0:
                self.children[parent].append(node)
            here = rows[members] if len(members) > leaf else None
            cut = _split(here) if here is not None and here.shape[1] else None
            if cut is None:
                self.members[node] = members, own, ranks[members]
            else:
                right = here[:, cut[0]] > cut[1]
                todo += [(members[~right], node), (members[right], node)]

    def _codes(self, rows: np.ndarray) -> np.ndarray:
        words = max(1, -(-len(self.dimensions) // 64))
        out = np.zeros((words, len(rows)), np.uint64)
        step = max(1, 4 * WORK // (64 * words))
        for at in range(0, len(rows), step):
            bits = np.packbits(rows[at:at + step, self.dimensions] > self.thresholds, axis=1)
            some = np.zeros((len(bits), 8 * words), np.uint8)
            some[:, :bits.shape[1]] = bits
            out[:, at:at + step] = some.view(np.uint64).T
        return out

    def near(self, queries: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, members) of all pairs whose member has one letter more,
        and (``same``: rows are as long as queries) one less, and the larger
        rank; where thresholds are quantiles, some that are farther too."""
        codes, ranks = self._codes(queries), rank(queries) if same else np.full(len(queries), -1)
        more = 1 - np.maximum(self.low - queries, 0).sum(axis=1)  # letters that members may have beyond the query's
        less = int(same) - np.maximum(queries - self.high, 0).sum(axis=1)
        todo = [(0, np.flatnonzero((more >= 0) & (less >= 0)))]
        more, less = np.maximum(more, 0).astype(np.uint8), np.maximum(less, 0).astype(np.uint8)
        while todo:
            node, asked = todo.pop()
            low, high, most = self.boxes[node]
            asked = asked[ranks[asked] < most]
            q = codes.take(asked, axis=1)
            asked = asked[(_bits(low[:, None] & ~q) <= more[asked]) & (_bits(q & ~high[:, None]) <= less[asked])]
            if not len(asked):
                continue
            if self.members[node] is None:
                todo += [(child, asked) for child in self.children[node]]
                continue
            members, own, their = self.members[node]
            step = max(1, WORK // len(members))
            for at in range(0, len(asked), step):
                some = asked[at:at + step]
                far = np.bitwise_count(codes[0, some][:, None] ^ own[0])
                x, y = np.divmod(np.flatnonzero(far <= 1 + same), len(members))
                x = some[x]
                kept = ranks[x] < their[y]
                x, y = x[kept], y[kept]
                kept = _bits(codes.take(x, axis=1) ^ own.take(y, axis=1)) <= more[x] + less[x]
                yield x[kept], members[y[kept]]


class TopTree:
    """Splits of the sample; each leaf is all of space between its planes."""

    def __init__(self, rows: np.ndarray, leaf: float):
        #: (dimension, threshold, left, right), or a leaf's number in the last place
        self.nodes: list[list[int]] = []
        self.leaves = 0
        todo = [(rows, -1, 0)]
        while todo:
            here, parent, side = todo.pop()
            node = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][side] = node
            cut = _split(here) if len(here) > max(leaf, 1) else None
            if cut is None:
                self.nodes.append([-1, 0, 0, self.leaves])
                self.leaves += 1
            else:
                self.nodes.append([*cut, -1, -1])
                right = here[:, cut[0]] > cut[1]
                todo += [(here[~right], node, 2), (here[right], node, 3)]

    def placed(self, rows: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows within ``radius`` of it); a radius of 0 places each row once."""
        box = np.full(DIMENSIONS, -1, np.int64), np.full(DIMENSIONS, 1 << 20, np.int64)
        todo = [(0, np.arange(len(rows)), *box)]
        while todo:
            node, here, low, high = todo.pop()
            if not len(here):
                continue
            d, t, left, right = self.nodes[node]
            if d < 0:
                yield right, here
                continue
            for child, a, b in ((left, low[d], min(t, high[d])), (right, max(t + 1, low[d]), high[d])):
                lower, upper = low.copy(), high.copy()
                lower[d], upper[d] = a, b
                r = rows[here]
                far = np.maximum(lower - r, 0).sum(axis=1) + np.maximum(r - upper, 0).sum(axis=1)
                todo.append((child, here[far <= radius], lower, upper))


def top_tree(words: DataFrame, cell_bytes: int, sample: int = SAMPLE) -> TopTree:
    """Fitted on a sample, to leaves that hold about ``cell_bytes`` of the length with most words."""
    some = [r.word for r in words.where(F.length("word") <= 64).select("word").orderBy(F.xxhash64("word"), "word").limit(sample).collect()]
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.sum(F.length("word") + 2 * DIMENSIONS).alias("size"))
    size = sizes.agg(F.max("size")).first()[0] or 0
    rows = np.concatenate([np.zeros((0, DIMENSIONS), np.int16), *[counts(_letters([w])) for w in some]])
    return TopTree(rows, max(LEAST_LEAF, len(rows) * cell_bytes / max(size, 1)))


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for length, group in groupby(order, key=lambda i: len(words[i])):
        group = list(group)
        step = max(1, 8 * WORK // max(length, DIMENSIONS))
        for at in range(0, len(group), step):
            yield length, group[at:at + step]


ROUTED = "length int, leaf int, query boolean, word string, n long"


def routed(words: DataFrame, tree: TopTree) -> DataFrame:
    """Each word once in its own cell, and as a query in each cell that it can reach in its length and the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            for length, group in _by_length(texts):
                rows = counts(_letters([texts[i] for i in group]))
                picked = batch.take(pa.array(group, pa.int64()))
                for more, radius, query in ((0, 0, False), (0, 2, True), (1, 1, True)):
                    for leaf, at in tree.placed(rows, radius):
                        some, m = picked.take(pa.array(at)), len(at)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(m, length + more, np.int32)), pa.array(np.full(m, leaf, np.int32)), pa.array(np.full(m, query)),
                            some.column("word"), some.column("n")], [c.split()[0] for c in ROUTED.split(", ")])

    return words.select("word", "n").mapInArrow(run, ROUTED)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words (columns of letters) differ in one place."""
    return (a != b).sum(axis=0) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``b`` are those of ``a`` with one letter more."""
    head = np.logical_and.accumulate(a == b[:-1], axis=0).sum(axis=0)
    tail = np.logical_and.accumulate((a == b[1:])[::-1], axis=0).sum(axis=0)
    return head + tail >= a.shape[0]


def _pairs_of(tree: Tree, letters: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, member) of all pairs one edit apart; ``letters`` and ``asked`` hold a word a column."""
    same = asked.shape[0] == letters.shape[0]
    verify = one_replaced if same else one_inserted
    each = max(1, WORK // letters.shape[0])
    for q, m in tree.near(counts(asked.T), same):
        for k in range(0, len(q), each):
            x, y = q[k:k + each], m[k:k + each]
            found = verify(asked.take(x, axis=1), letters.take(y, axis=1))
            yield x[found], y[found]


PAIRS = "a string, na long, b string, nb long"


def _together(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, at least ``BATCH`` at a time."""
    waiting, n = [], 0
    for x, y in pairs:
        waiting.append((x, y))
        n += len(x)
        if n >= BATCH:
            yield tuple(map(np.concatenate, zip(*waiting)))
            waiting, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*waiting)))


class _Cell:
    """The members of a cell, and queries that wait to be searched together."""

    def __init__(self):
        self.words, self.ns, self.asked, self.asked_ns, self.tree = [], [], [], [], None

    def pairs(self) -> Iterator[pa.RecordBatch]:
        """All pairs of the waiting queries and a member one edit apart."""
        asked, ns = self.asked, self.asked_ns
        self.asked, self.asked_ns = [], []
        if not asked or not self.words:
            return
        if self.tree is None:
            rows = _letters(self.words)
            self.tree, self.letters = Tree(counts(rows)), np.ascontiguousarray(rows.T)
        for _, some in _by_length(asked):
            a = [asked[i] for i in some]
            for q, m in _together(_pairs_of(self.tree, self.letters, np.ascontiguousarray(_letters(a).T))):
                q, m = q.tolist(), m.tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([a[x] for x in q]), pa.array([ns[some[x]] for x in q], pa.int64()),
                    pa.array([self.words[y] for y in m]), pa.array([self.ns[y] for y in m], pa.int64())], ["a", "na", "b", "nb"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by cell, members before queries: all pairs of a query and a member one edit apart, each once."""
    at, cell = None, _Cell()
    for batch in batches:
        texts, numbers, query = batch.column("word").to_pylist(), batch.column("n").to_pylist(), batch.column("query").to_numpy(zero_copy_only=False)
        keys = np.stack([batch.column(c).to_numpy() for c in ("length", "leaf", "part", "share")])
        begins = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) if batch.num_rows else []
        for first, last in zip(begins, [*begins[1:], batch.num_rows]):
            if tuple(keys[:, first]) != at:
                yield from cell.pairs()
                at, cell = tuple(keys[:, first]), _Cell()
            split = first + int((~query[first:last]).sum())
            cell.words += texts[first:split]
            cell.ns += numbers[first:split]
            cell.asked += texts[split:last]
            cell.asked_ns += numbers[split:last]
            if len(cell.asked) >= TOGETHER:
                yield from cell.pairs()
    yield from cell.pairs()


def near_pairs(words: DataFrame, cell_bytes: int = CELL_BYTES, cell_queries: int = CELL_QUERIES, sample: int = SAMPLE) -> DataFrame:
    """(a, na, b, nb): each pair of ``words`` (word, n; distinct, of the letters of ``RUN``) one edit apart, once."""
    rows = written(routed(words, top_tree(words, cell_bytes, sample)), "cells")
    size = (F.col("length") + 2 * DIMENSIONS).cast("bigint")
    cells = rows.groupBy("length", "leaf").agg(
        F.sum(F.when(~F.col("query"), size).otherwise(0)).alias("bytes"), F.sum(F.col("query").cast("bigint")).alias("queries"))
    cells = cells.where("bytes > 0 AND queries > 0").select(
        "length", "leaf", F.ceil(F.col("bytes") / cell_bytes).cast("int").alias("parts"), F.ceil(F.col("queries") / cell_queries).cast("int").alias("shares"))
    dealt = rows.join(cells, ["length", "leaf"])

    def own(of: str):
        return F.array(F.pmod(F.xxhash64("word"), F.col(of)).cast("int"))

    def every(of: str):
        return F.sequence(F.lit(0), F.col(of) - 1)
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("query"), every("parts")).otherwise(own("parts"))))
    dealt = dealt.withColumn("share", F.explode(F.when(F.col("query"), own("shares")).otherwise(every("shares"))))
    key = ["length", "leaf", "part", "share"]
    return (dealt.select(*key, "query", "word", "n").repartition(*key).sortWithinPartitions(*key, "query")
            .mapInArrow(_searched, PAIRS))


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of each of ``words``."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    best_n = -F.col("best.n")
    taken = best_n >= 2 * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, best_n).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words of ``links`` (word, form) that have a form: each round doubles the way that is known."""
    folder = shared_folder(links.sparkSession, "roots")
    now = written(links.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "", f"{folder}/0")
    turn = 0
    while not now.where("moved").isEmpty():
        turn += 1
        a, b = now.alias("a"), now.alias("b")
        step = a.join(b, F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved"))
        now = written(step, "", f"{folder}/{turn}")
        dropped(links.sparkSession, [f"{folder}/{turn - 1}"])
    return now.select("word", "root")


def variants(docs: DataFrame, cell_bytes: int = CELL_BYTES, cell_queries: int = CELL_QUERIES, sample: int = SAMPLE) -> DataFrame:
    """For each word of ``docs``: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs), "words")
    found = written(forms(words, near_pairs(words, cell_bytes, cell_queries, sample)), "forms")
    return found.join(roots(found), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
