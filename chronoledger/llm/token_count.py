"""Token counts of a byte-level BPE vocabulary, without making token ids.

A run of a text's bytes (a pre-token) starts as single byte symbols; the
adjacent pair of the lowest rank is popped from a heap and merged in a linked
list, again and again. The count is the initial symbols minus the merges.

Texts are independent, so the job is one pass without a shuffle. A worker
remembers counts of words and runs it has seen, in tables of bounded size;
they save time and never change a result.

Defined cases: a NULL or empty text has no tokens; special strings inside a
text are one token each, as the library takes them by default; repeated rows
each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import whole_text

#: Fixed value: the published split of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 400_000
LIMIT = 512


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary:
    a printable byte itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def count_merged(symbols: list[str], rank: dict[tuple[str, str], int]) -> int:
    """Symbols left when all merges are done."""
    n = len(symbols)
    best = [rank.get(pair, -1) for pair in zip(symbols, symbols[1:])]
    heap = [(r, i) for i, r in enumerate(best) if r >= 0]
    if not heap:
        return n
    heapq.heapify(heap)
    best.append(-1)
    after, before, left = list(range(1, n + 1)), list(range(-1, n - 1)), n
    while heap:
        r, i = heapq.heappop(heap)
        if best[i] != r:  # one of the two has been merged since
            continue
        j = after[i]
        symbols[i] += symbols[j]
        best[j] = -1
        k = after[i] = after[j]
        left -= 1
        best[i] = -1
        if k < n:
            before[k] = i
            r = rank.get((symbols[i], symbols[k]), -1)
            if r >= 0:
                best[i] = r
                heapq.heappush(heap, (r, i))
        p = before[i]
        if p >= 0:
            best[p] = r = rank.get((symbols[p], symbols[i]), -1)
            if r >= 0:
                heapq.heappush(heap, (r, p))
    return left


class Counter:
    """Counts tokens of whole texts."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            book = json.load(f)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in book["model"]["merges"]]
        self.rank = {pair: r for r, pair in enumerate(pairs)}
        special = [t["content"] for t in book["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in book["added_tokens"]):
            raise ValueError("special tokens that take in what is beside them aren't supported")
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.runs_of = regex.compile(PATTERN).findall
        # Where no two spaces meet and the only ones are " " and "\n", a word
        # and the space before it are apart from all other words.
        self.simple = regex.compile(r"[^\S \n]|[ \n][ \n]|" + self.special.pattern).search
        self.table = {b: s for b, s in byte_symbols().items()}
        self.forget()

    def forget(self) -> None:
        self.runs: dict[str, int] = {}
        self.spaced: dict[str, int] = {"": 1}
        self.first: dict[str, int] = {"": 0}

    def run(self, run: str) -> int:
        """Tokens of one pre-token."""
        n = self.runs.get(run)
        if n is None:
            n = count_merged(list(run.encode().decode("latin-1").translate(self.table)), self.rank)
            if len(run) <= 64:
                self.runs[run] = n
        return n

    def plain(self, text: str) -> int:
        return sum(map(self.run, self.runs_of(text)))

    def __call__(self, text: str) -> int:
        if len(self.runs) + len(self.spaced) + len(self.first) > 2 * REMEMBERED:
            self.forget()
        if self.simple(text):
            return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))
        total, spaced, first = text.count("\n"), self.spaced, self.first
        for line in text.split("\n"):
            words = line.split(" ")
            head = words.pop(0)
            if head not in first:
                first[head] = self.plain(head)
            total += first[head]
            try:
                total += sum(map(spaced.__getitem__, words))
            except KeyError:
                for w in words:
                    if w not in spaced:
                        spaced[w] = self.plain(" " + w)
                    total += spaced[w]
        return total


_COUNTERS: dict[str, Counter] = {}


def _counter(name: str) -> Counter:
    """This worker's counter for a vocabulary file (a path, or a name in public_tokenizers)."""
    if name not in _COUNTERS:
        path = name
        if os.sep not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _COUNTERS[name] = Counter(path)
    return _COUNTERS[name]


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary)
        for batch in batches:
            n = pa.array([count(t) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.octet_length(whole_text()).cast("bigint").alias("n_bytes"),
                       whole_text().alias("text"))
    return (rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
