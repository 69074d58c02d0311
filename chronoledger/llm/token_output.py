"""Token ids in a binary file format: canonical Huffman codes of limited length.

Files of one output folder:

* ``codebook``: (id, length), the code length of each id that occurs. Codes
  are canonical, so lengths say everything; lengths are those of an optimal
  code among all of at most ``limit`` bits (package-merge over the global
  counts).
* ``blocks``: a row for each block of whole documents: the documents' ids
  and lengths, the coded ids as one bit string, and checkpoints, the bit
  offset of every ``stride``-th id. A block needs nothing but the codebook.

Documents are range-partitioned by ``doc_id``; a partition is a shard, its
blocks follow one another, and an id's place in the whole output is the sum
of the shards before, the block's first place and the place in the block.

Texts are encoded once, into a table in the shared folder. The driver holds
counts and code lengths only, at most a row for each id of the vocabulary.

Defined cases: a NULL text is empty and holds the end id alone; documents
without an id come first; repeated rows are written each (equal ids: by
their token ids); an empty table gives no blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoledger.llm.common import dropped, shared_folder, whole_text

LIMIT, STRIDE, BLOCK_IDS = 18, 256, 1 << 18
REMEMBERED, LONG_PIECE = 300_000, 100
PIECE_BYTES = 1 << 20
WORD_END = "</w>"
#: ASCII and the Latin letters of one byte that are composed.
PLAIN = bytes([*range(0x80), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
LATIN = re.compile(r"[a-z\xDF-\xF6\xF8-\xFF]+").fullmatch
PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^\x20\x09-\x0D0-9a-z\xDF-\xF6\xF8-\xFF]+").findall
ASCII_SPACE = re.compile(r"[^\x20\x09-\x0D]+").findall


def _plain(text: str) -> bool:
    """Whether a text is of PLAIN characters, without what could begin a special token."""
    if "<|" in text:
        return False
    try:
        return text.isascii() or not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return False


class Encoder:
    """A tokenizer whose tokens never span white space, called once for each
    piece of text that is not remembered (the memory is bounded, and only
    saves time).

    Texts of ASCII and Latin letters are put in lower case, as the
    tokenizer does, and cut where it cuts: into runs of letters, digits and
    marks. New runs of letters are encoded together and told apart by the
    word-end marks of their last tokens. Other texts are cut at white space.
    Ids are little-endian, of two bytes where the vocabulary allows.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        top = max(vocabulary.values(), default=0)
        self.dtype = "<u2" if top < 1 << 16 else "<u4"
        self.last = np.zeros(top + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith(WORD_END)
        #: Ids by piece of text: what was seen lately, and what was before it. When there are too many, the older go.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def _letters(self, runs: list[str]) -> list[bytes]:
        """The ids of runs of letters."""
        if not runs:
            return []
        found = self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)
        ids = np.array(found[0].ids, self.dtype)
        ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
        if len(ends) != len(runs) or ends[-1] != ids.nbytes:
            return self._each(runs)
        whole = ids.tobytes()
        ends = ends.tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, new: set[str]) -> None:
        """Ids of pieces that aren't remembered."""
        known, older = self.known, self.older
        again = [x for x in new if x in older]
        known.update(zip(again, map(older.__getitem__, again)))
        left = new.difference(again)
        runs = [x for x in left if LATIN(x)]
        known.update(zip(runs, self._letters(runs)))
        other = [x for x in left if x not in known]
        known.update(zip(other, self._each(other)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """For each text its ids."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        cut = [PIECES(t.lower()) if _plain(t) else ASCII_SPACE(t) for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.known)
        self._learn(new)
        look = self.known.__getitem__
        out = [b"".join(map(look, pieces)) for pieces in cut]
        for x in new:
            if len(x) > LONG_PIECE:
                del self.known[x]
        return out


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    """This worker's encoder for a vocabulary file (a path, or a name in public_tokenizers)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if name not in _ENCODERS:
        path = name
        if os.sep not in name:
            import public_tokenizers

            path = public_tokenizers.path(name)
        _ENCODERS[name] = Encoder(path)
    return _ENCODERS[name]


def _pieces(column: pa.Array) -> Iterator[tuple[int, list]]:
    """(first row, values) of stretches of a column of strings or bytes, of about ``PIECE_BYTES``."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right")))
        yield at, column.slice(at, to - at).to_pylist()
        at = to


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(doc_id, ids): each whole text's ids and the end id, in the encoder's type."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        end = np.array([end_id], encode.dtype).tobytes()
        for batch in batches:
            for at, piece in _pieces(batch.column("text")):
                ids = pa.array([x + end for x in encode(piece)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(piece)), ids], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def id_counts(ids: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all documents: each task sends one row for each id it saw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for _, piece in _pieces(batch.column("ids")):
                n = np.bincount(np.frombuffer(b"".join(piece), dtype), minlength=len(total))
                n[:len(total)] += total
                total = n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        levels.append(at < n)
        both = both[at]
        packages = both[:len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        taken = int(is_leaf[:take].sum())
        lengths[order[:taken]] += 1
        take = 2 * (take - taken)
    return lengths


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    order = np.lexsort((ids, lengths))
    step = np.left_shift(np.int64(1), int(lengths.max(initial=1)) - lengths[order])
    codes = np.empty(len(ids), np.int64)
    codes[order] = (np.cumsum(step) - step) >> (int(lengths.max(initial=1)) - lengths[order])
    return codes


class Book:
    """Coder and decoder of one codebook."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, limit: int = LIMIT):
        self.limit = limit
        codes = canonical_codes(ids, lengths)
        self.code = np.zeros(int(ids.max(initial=0)) + 1, np.uint64)
        self.length = np.zeros(len(self.code), np.int64)
        self.code[ids], self.length[ids] = codes, lengths
        self.table = np.zeros(1 << limit, np.uint32)
        order = np.argsort(codes << (limit - lengths))  # codes follow one another: each fills its stretch
        entries = np.repeat((ids << 5 | lengths)[order].astype(np.uint32), (1 << (limit - lengths))[order])
        self.table[:len(entries)] = entries

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
        """The bit string, and the bit offset of every ``stride``-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        n = self.length[ids]
        end = np.cumsum(n)
        at = end - n
        value = self.code[ids] << (64 - n - (at & 31)).astype(np.uint64)
        first = np.flatnonzero(np.r_[True, np.diff(at >> 5) > 0])
        word = (at >> 5)[first]
        out = np.zeros(int(end[-1] >> 5) + 2, np.uint64)  # bits are disjoint: sums are ors
        out[word] += np.add.reduceat(value >> np.uint64(32), first)
        out[word + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return out.astype(">u4").tobytes()[:(int(end[-1]) + 7) // 8], at[::stride]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, stride: int = STRIDE) -> np.ndarray:
        """All ids: every checkpoint's run at once, one table look-up for each id."""
        words = np.frombuffer(payload + b"\0" * (8 + -len(payload) % 4), ">u4").astype(np.uint64)
        at, most = checkpoints.astype(np.int64), (len(words) - 2) * 32
        out = np.empty((len(at), stride), np.uint32)
        mask, room = np.uint64((1 << self.limit) - 1), 64 - self.limit
        for k in range(stride if len(at) > 1 else n):
            w = at >> 5
            bits = (words[w] << np.uint64(32) | words[w + 1]) >> (room - (at & 31)).astype(np.uint64) & mask
            entry = self.table[bits]
            out[:, k] = entry >> 5
            at = np.minimum(at + (entry & 31), most)
        return out.ravel()[:n]


BLOCK = ("shard int, block int, first_id long, n_ids long, doc_ids array<long>, lengths array<int>, "
         "payload binary, checkpoints array<long>")


def _blocks(book: Book, dtype: str):
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.dtype(dtype).itemsize
        shard, block, before, docs, texts, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def row():
            payload, checkpoints = book.encode(np.frombuffer(b"".join(texts), dtype))
            values = [shard, block, before, held, docs, [len(t) // wide for t in texts], payload, checkpoints]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in BLOCK.split(", ")])
        for batch in batches:
            for at, piece in _pieces(batch.column("ids")):
                for doc, ids in zip(batch.column("doc_id").slice(at, len(piece)).to_pylist(), piece):
                    docs.append(doc)
                    texts.append(ids)
                    held += len(ids) // wide
                    if held >= BLOCK_IDS:
                        yield row()
                        block, before, docs, texts, held = block + 1, before + held, [], [], 0
        if docs:
            yield row()
    return run


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str, limit: int = LIMIT) -> None:
    """Encode all ``docs`` (doc_id, text) into the file format, in ascending order of ``doc_id``."""
    spark = docs.sparkSession
    staged = f"{folder}/staged"
    encoded(docs, vocabulary, end_id).write.option("compression", "zstd").parquet(staged)
    ids = spark.read.schema("doc_id long, ids binary").parquet(staged)
    dtype = _encoder(vocabulary).dtype
    counts = id_counts(ids, dtype).orderBy("id").toPandas()  # at most the vocabulary
    symbols, lengths = counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(np.int64), limit)
    spark.createDataFrame(list(zip(symbols.tolist(), lengths.tolist())), "id long, length int").coalesce(1) \
        .write.parquet(f"{folder}/codebook")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(_blocks(Book(symbols, lengths, limit), dtype), BLOCK) \
        .write.option("compression", "none").parquet(f"{folder}/blocks")
    dropped(spark, [staged])


_BOOKS: dict[str, Book] = {}


def _book(folder: str, ids: np.ndarray, lengths: np.ndarray, limit: int) -> Book:
    """This worker's book of a folder, built once."""
    if folder not in _BOOKS:
        _BOOKS.clear()
        _BOOKS[folder] = Book(ids, lengths, limit)
    return _BOOKS[folder]


def _decoded(spark: SparkSession, folder: str, limit: int, value: Callable[[list[bytes]], pa.Array], field: str) -> DataFrame:
    """(doc_id, start, n_tokens, and ``value`` of the ids) of every document in the files."""
    codes = spark.read.schema("id long, length int").parquet(f"{folder}/codebook").toPandas()  # at most the vocabulary
    blocks = spark.read.schema(BLOCK).parquet(f"{folder}/blocks")
    book = (folder, codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64), limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _book(*book)
        for batch in batches:
            for row in range(batch.num_rows):
                b = {c: batch.column(c)[row] for c in batch.schema.names}
                ids = decoder.decode(b["payload"].as_py(), b["checkpoints"].values.to_numpy(), b["n_ids"].as_py())
                lengths = b["lengths"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(lengths)
                whole = memoryview(ids.astype("<u4", copy=False).tobytes())
                texts = [whole[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ends), b["shard"].as_py(), np.int32)), b["doc_ids"].values,
                    pa.array(b["first_id"].as_py() + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                    value(texts)], ["shard", "doc_id", "place", "n_tokens", field.split()[0]])

    # A row for each shard, of which there are as many as partitions were written.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return (blocks.mapInArrow(run, f"shard int, doc_id long, place long, n_tokens long, {field}").join(F.broadcast(starts), "shard")
            .select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", field.split()[0]))


def read(spark: SparkSession, folder: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files."""
    return _decoded(spark, folder, limit, lambda texts: pa.array(map(bytes, texts), pa.binary()), "ids binary")


def digests(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """Write ``docs`` to files in the shared folder; per document, from the
    files: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "tokens")
    write(docs, vocabulary, end_id, folder)
    return _decoded(spark, folder, LIMIT, lambda texts: pa.array(map(zlib.crc32, texts), pa.int64()), "ids_crc32 long")
