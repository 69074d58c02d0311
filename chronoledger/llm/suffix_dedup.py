"""Exact repeats of ``length`` bytes, from sparse enhanced suffix arrays.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else, in the same document or another. Shorter repeats, from
``passage`` bytes on (about fifty words can be as few), are found in the same
pass and counted, not removed.

Anchors make the suffix array sparse and split it between tasks. Of the
grams (``GRAM`` bytes) in each window of ``passage`` bytes the one of the
least hash is an anchor, about one in 105 bytes; those that are an anchor of
windows of ``length`` bytes as well are wide. Equal windows choose the
same gram at the same place, so every repeat is a pair of suffixes that
start at equal anchors, and only suffixes at anchors whose hash occurs twice
are kept: for each, the bytes after the anchor and those before it, as far
as a window (at a wide anchor, one of ``length``) can reach.

Spark sorts them by (hash, bytes after): each hash's rows are a piece of the
suffix array. A stack-scan over the common prefixes of neighbours gives the
interval tree; at each interval the members are put in order of the bytes
before their anchors, and where these differ (left-extension diversity) tell
how far each member is alike to the left to any other. A member whose
common prefix and common left extension together reach ``length`` is an
occurrence of a repeat; all occurrences of a group come out, each as the
union of its repeats.

Copies: texts that occur twice or more are removed whole if they are long
enough, and only one of them is searched; equal surroundings of anchors
within a text (it repeats itself with a period) are one place, and equal
surroundings within a batch are sent once. A hash with more than ``max_group`` suffixes is
settled by counting the windows around its anchors, by key, with partial
sums, so that no task has to hold them all.

Defined cases: a NULL text is empty; texts of fewer than ``length`` bytes
keep all, and those of fewer than ``passage`` hold no repeat; equal rows are copies of each other, whatever their ids; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import let, running, whole_text, written

LENGTH, PASSAGE, GRAM = 400, 240, 32
MAX_GROUP = 50_000
SUFFIXES = "hash long, tkey binary, pos long, before binary, after binary"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16), base)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS


def anchors(text: bytes, length: int = LENGTH, passage: int = PASSAGE, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a text's anchors, the hashes of their grams, and which are wide."""
    n = len(text)
    if n < passage:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    m = n - gram + 1
    hashes = (sums[gram:] - sums[:m]) * down[:m]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    # Least by the upper half of the hash, then leftmost.
    key = hashes & np.uint64(0xFFFFFFFF00000000) | np.arange(m, dtype=np.uint64)

    def least(size: int) -> np.ndarray:
        """The place of the least gram of each window of ``size`` bytes, once each."""
        if n < size:
            return np.zeros(0, np.int64)
        wide = size - gram + 1
        rows = np.full(-(-m // wide) * wide, np.uint64(0xFFFFFFFFFFFFFFFF))
        rows[:m] = key
        rows = rows.reshape(-1, wide)
        head = np.minimum.accumulate(rows, axis=1).ravel()
        tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - size + 1
        at = (np.minimum(tail[:windows], head[wide - 1:wide - 1 + windows]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        return at[np.r_[True, at[1:] != at[:-1]]]

    at = least(passage)  # a longer window's least is the least of a shorter one that holds it
    return at, hashes[at].view(np.int64), np.isin(at, least(length), assume_unique=True)


def _around(text: bytes, at: int, reach: int) -> tuple[bytes, bytes]:
    """The bytes before and after an anchor that windows of ``reach`` bytes with it can reach."""
    return text[max(0, at - reach + GRAM):at], text[at:at + reach]


def _places(text: bytes, length: int, passage: int) -> list[tuple[int, int, bool, bool]]:
    """(place, hash, wide, again) of a text's anchors; of those with equal surroundings the first, marked."""
    at, hashes, wide = anchors(text, length, passage)
    if len(np.unique(hashes)) == len(hashes):
        return list(zip(at.tolist(), hashes.tolist(), wide.tolist(), [False] * len(at)))
    found: dict[tuple, list] = {}
    for p, h, w in zip(at.tolist(), hashes.tolist(), wide.tolist()):
        before, after = _around(text, p, length if w else passage)
        own = found.setdefault((h, len(before), blake2b(before + after, digest_size=16).digest()), [p, h, w, False])
        own[3] = own[0] != p
    return [tuple(x) for x in found.values()]


def _anchor_rows(length: int, passage: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *x) for i, t in enumerate(batch.column("text").to_pylist()) for x in _places(t, length, passage)]
            if found:
                rows, at, hashes, wide, again = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    batch.column("tkey").take(pa.array(rows, pa.int64())), pa.array(hashes, pa.int64()), pa.array(at, pa.int64()),
                    pa.array(wide, pa.bool_()), pa.array(again, pa.bool_())], ["tkey", "hash", "pos", "wide", "again"])
    return run


def _stretches(text: bytes, around: bytes) -> Iterator[tuple[int, int]]:
    """What the occurrences of ``around`` cover, as maximal runs."""
    at = text.find(around)
    start, end = at, at + len(around)
    while (at := text.find(around, at + 1)) >= 0:
        if at > end:
            yield start, end
            start = at
        end = at + len(around)
    yield start, end


def _suffix_rows(length: int, passage: int):
    """The surroundings of each place; of equal ones in a batch the first, and
    for all of them a row without surroundings that says how far they reach
    (and whether as repeats of ``length``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, list] = {}
            out: list[tuple] = []

            def settled(tkey: bytes, start: int, end: int, size: int) -> None:
                # dealt by its own text: a common hash would gather them
                told = (end - start).to_bytes(8, "big") + bytes([size >= length])
                out.append((int.from_bytes(tkey[:8], "big", signed=True), tkey, start, None, told))

            for tkey, text, places in zip(*(batch.column(c).to_pylist() for c in ("tkey", "text", "places"))):
                for p in places:
                    at = p["pos"]
                    before, after = _around(text, at, length if p["wide"] else passage)
                    size = len(before) + len(after)
                    if size < passage:
                        continue
                    if p["again"]:
                        for start, end in _stretches(text, before + after):
                            settled(tkey, start, end, size)
                    own = (p["hash"], blake2b(before + after, digest_size=16).digest(), len(before))
                    if own not in seen:
                        seen[own] = [tkey, at, p["again"]]
                        out.append((p["hash"], tkey, at, before, after))
                        continue
                    first = seen[own]
                    if not first[2]:
                        settled(first[0], first[1] - len(before), first[1] - len(before) + size, size)
                        first[2] = True
                    if not p["again"]:
                        settled(tkey, at - len(before), at - len(before) + size, size)
                if len(out) > 4000:
                    yield _batch(out)
                    out.clear()
            if out:
                yield _batch(out)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in SUFFIXES.split(", ")])


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width), n


def _alike(rows: np.ndarray, n: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many first bytes each row shares with the next, in ``order``."""
    same = rows[order[:-1]] == rows[order[1:]]
    first = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return np.minimum(first, np.minimum(n[order[:-1]], n[order[1:]]))


def intervals(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of each interval of the common-prefix tree, by a
    stack-scan over the common prefixes of neighbours."""
    stack = [(0, 0)]
    for i, depth in enumerate([*common.tolist(), 0], 1):
        first = i - 1
        while stack[-1][0] > depth:
            deep, first = stack.pop()
            yield deep, first, i - 1
        if stack[-1][0] < depth:
            stack.append((depth, first))


def occurrences(before: list[bytes], after: list[bytes], lengths: tuple[int, ...] = (LENGTH,)) -> list[tuple[np.ndarray, np.ndarray]]:
    """For suffixes in order of ``after``, and each of ``lengths``: how far each
    is an occurrence of a repeat to the left and to the right of its anchor (0, 0: it is none)."""
    m = len(after)
    right, n_right = _matrix(after, max(lengths))
    left, n_left = _matrix([b[::-1] for b in before], max(lengths) - GRAM)
    rank = np.empty(m, np.int64)
    rank[np.lexsort((n_left, np.array([b[::-1] for b in before], object)))] = np.arange(m)
    far = [(np.zeros(m, np.int64), np.zeros(m, np.int64)) for _ in lengths]
    for depth, first, last in intervals(_alike(right, n_right, np.arange(m))):
        members = first + np.argsort(rank[first:last + 1])
        beside = _alike(left, n_left, members)
        if depth + beside.max() < min(lengths):
            continue
        most = np.maximum(np.r_[beside, 0], np.r_[0, beside])  # the most alike is a neighbour
        for length, (far_left, far_right) in zip(lengths, far):
            repeated = most + depth >= length
            at, own = members[repeated], most[repeated]
            far_left[at] = np.maximum(far_left[at], own)
            far_right[at] = np.maximum(far_right[at], depth)
    return far


def _spans(length: int, passage: int):
    """Over rows sorted by (hash, after): (hash, tkey, start, end, long) of
    each occurrence; ``long`` are repeats of ``length``."""
    def of(rows: list[tuple]) -> list[tuple]:
        out = [(h, k, a, a + int.from_bytes(n[:8], "big"), bool(n[8])) for h, k, a, b, n in rows if b is None]
        rows = [r for r in rows if r[3] is not None]
        if len(rows) > 1:
            far = occurrences([r[3] for r in rows], [r[4] for r in rows], (length, passage))
            for is_long, (lefts, rights) in zip((True, False), far):
                out += [(r[0], r[1], r[2] - x, r[2] + y, is_long) for r, x, y in zip(rows, lefts.tolist(), rights.tolist()) if y]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    out += of(held)
                    held = []
                held.append(row)
            if out:
                yield _span_batch(out)
        if held and (out := of(held)):
            yield _span_batch(out)
    return run


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["repeat", "tkey", "start", "end", "long"])


def _window_rows(length: int, passage: int):
    """(key, tkey, start, size) of every window around each place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tkey, text, places in zip(*(batch.column(c).to_pylist() for c in ("tkey", "text", "places"))):
                for p in places:
                    before, after = _around(text, p["pos"], length if p["wide"] else passage)
                    here = list(_stretches(text, before + after)) if p["again"] else [(p["pos"] - len(before), p["pos"] + len(after))]
                    for size in sorted({length, passage}):
                        starts = [a for start, end in here for a in range(start, end - size + 1)]
                        keys = [blake2b(text[a:a + size], digest_size=16).digest() for a in starts]
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([tkey] * len(keys), pa.binary()),
                                                          pa.array(starts, pa.int64()), pa.array(np.full(len(keys), size, np.int32))],
                                                         ["key", "tkey", "start", "size"])
    return run


def _long_texts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Texts long enough, and (tkey, n, rep): how many there are of each, and the id of the one that is searched."""
    text = whole_text().cast("binary")
    long = (docs.select(F.col("doc_id").alias("doc_id"), F.unhex(F.md5(text)).alias("tkey"), text.alias("text"))
            .where(F.octet_length("text") >= least))
    return long, long.groupBy("tkey").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep"))


def _searched(long: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen texts (tkey, rep, ...), looked up by text and id so that copies spread."""
    t, c = long.alias("t"), chosen.alias("c")
    return (t.join(c, (F.col("t.tkey") == F.col("c.tkey")) & F.col("t.doc_id").eqNullSafe(F.col("c.rep")))
            .select("t.doc_id", "t.tkey", "t.text", *[f"c.{x}" for x in chosen.columns if x not in ("tkey", "rep")]))


def repeats(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP, passage: int | None = None) -> DataFrame:
    """(repeat, tkey, start, end, long): all occurrences of each group of repeats in
    the distinct texts of ``docs``; tkey is a text's MD5. Repeats of ``length`` are long;
    shorter ones are told from ``passage`` bytes on (default: none)."""
    passage = passage or length
    long, copies = _long_texts(docs, passage)
    found = long.select("tkey", "text").mapInArrow(_anchor_rows(length, passage), "tkey binary, hash long, pos long, wide boolean, again boolean").distinct()
    often = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("within")).where("n > 1 OR within").drop("within")
    places = written(found.join(often, "hash"), "anchors")

    def texts(some: DataFrame) -> DataFrame:
        lists = some.groupBy("tkey").agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "wide", "again"))).alias("places"))
        return _searched(long, lists.join(copies.select("tkey", "rep"), "tkey")).select("tkey", "text", "places")

    suffixes = texts(places.where(F.col("n") <= max_group)).mapInArrow(_suffix_rows(length, passage), SUFFIXES)
    spans = (suffixes.repartition("hash").sortWithinPartitions("hash", "after")
             .mapInArrow(_spans(length, passage), "repeat long, tkey binary, start long, end long, long boolean"))
    if not places.where(F.col("n") > max_group).isEmpty():
        windows = texts(places.where(F.col("n") > max_group)).mapInArrow(_window_rows(length, passage), "key binary, tkey binary, start long, size int").distinct()
        twice = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        spans = spans.unionByName(windows.join(twice, "key").select(
            F.xxhash64("key").alias("repeat"), "tkey", "start", (F.col("start") + F.col("size")).alias("end"), (F.col("size") >= length).alias("long")))
    return spans


def _runs(spans: Column) -> Column:
    """Maximal runs (start, end) that the spans cover."""
    def merged(s: Column) -> Column:
        reach = running(F.transform(s, lambda x: x["end"]), F.lit(-1).cast("bigint"), lambda a, b: F.greatest(a, b))

        def begun(r: Column) -> Column:
            begins = F.filter(F.transform(s, lambda x, i: F.when(x["start"] > F.get(r, i), i)), lambda i: i.isNotNull())
            return let(begins, lambda b: F.transform(b, lambda i, k: F.struct(
                F.get(s, i)["start"].alias("start"), F.coalesce(F.get(r, F.get(b, k + 1)), F.array_max(F.transform(s, lambda x: x["end"]))).alias("end"))))
        return let(reach, begun)
    return let(F.array_sort(spans), merged)


def remove_repeats(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP, passage: int | None = None) -> DataFrame:
    """For each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, ``kept``
    (the bytes that stay) and n_repeated, the bytes in repeats of ``passage`` or more (default: ``length``)."""
    passage = passage or length
    long, copies = _long_texts(docs, passage)
    span = F.struct("start", "end")
    runs = repeats(docs, length, max_group, passage).groupBy("tkey").agg(F.collect_list(F.when(F.col("long"), span)).alias("spans"), F.collect_list(span).alias("all"))
    covered = F.aggregate(_runs(F.col("all")), F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["start"])
    runs = runs.select("tkey", F.when(F.size("spans") > 0, _runs(F.col("spans"))).alias("runs"), covered.alias("n_repeated"))
    single = copies.where("n = 1").select("tkey", "rep").join(runs, "tkey", "left")
    text = F.col("text")

    def piece(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get("runs", i - 1)["end"])
        end = F.coalesce(F.get("runs", i)["start"], F.octet_length(text).cast("bigint"))
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))
    kept = F.when(F.col("runs").isNull(), text).otherwise(F.aggregate(
        F.sequence(F.lit(0), F.size("runs")), F.lit(b""), lambda a, i: F.concat(a, piece(i))))
    size, none = F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")
    alone = _searched(long, single).select(
        "doc_id", size.alias("n_bytes"), kept.alias("kept"), F.greatest(F.size("runs"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("n_repeated", none).alias("n_repeated"))
    whole = size >= length
    copied = (long.select("doc_id", "tkey", size.alias("n_bytes"), F.when(whole, F.lit(b"")).otherwise(text).alias("kept"), whole.cast("bigint").alias("n_spans"))
              .join(copies.where("n > 1").select("tkey"), "tkey").select("doc_id", "n_bytes", "kept", "n_spans", F.col("n_bytes").alias("n_repeated")))
    every = whole_text().cast("binary")
    short = docs.where(F.octet_length(every) < passage).select(
        F.col("doc_id").alias("doc_id"), F.octet_length(every).cast("bigint").alias("n_bytes"), every.alias("kept"), none.alias("n_spans"), none.alias("n_repeated"))
    rows = alone.unionByName(copied).unionByName(short)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans", "kept", "n_repeated")


def digests(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    rows = remove_repeats(docs, length, passage=passage)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")
