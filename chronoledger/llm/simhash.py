"""Near-duplicates by SimHash, found in a grid of per-segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits, and each segment
is mapped to its bit count (0, 1 or 2). The Manhattan distance of two such
vectors is at most the Hamming distance of the fingerprints. Counts are held
in unary (00, 01, 11), which is each segment with its set bits moved to the
low end, so the Manhattan distance of two vectors is the number of
differing bits of two such words.

The grid: the segments are dealt into groups; among ``groups`` groups at
least ``groups - max_distance`` agree in every segment's count when the
Manhattan distance is at most ``max_distance``. Each choice of that many
groups is a table whose cells are the counts in them; pairs within a cell
are tested by their Manhattan distance (the lower bound) and then exactly.

Equal fingerprints are one row before the grid, so copies cost nothing. A
cell gives a spanning forest of its links, at most one link for each member,
and never its pairs. A cell of more than ``max_cell`` fingerprints is split
into blocks, and each two blocks are tested together in a task of their own.

Defined cases: NULL text counts as empty and has fingerprint zero, linked
like any other; repeated rows each give a row; a NULL id stays NULL and
never becomes a component's id unless all its ids are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoledger.llm.common import whole_text, written
from chronoledger.llm.components import components

SHINGLE, MAX_DISTANCE, GROUPS, MAX_CELL = 4, 4, 6, 1 << 16
SEED = 42
LOW_BITS = 0x5555555555555555
FLUSH = 1 << 17


def _text_hashes(text: bytes, shingle: int) -> Iterator[list[int]]:
    """Hashes of the word shingles of a whole text, in pieces of bounded length."""
    from xxhash import xxh64_intdigest as h

    words = text.lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= shingle:
        yield [h(joined, SEED)]
        return
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = len(words) - shingle + 1
    for at in range(0, n, FLUSH):
        to = min(n, at + FLUSH)
        yield [h(joined[a:b - 1], SEED) for a, b in zip(starts[at:to], ends[at + shingle - 1:to + shingle - 1])]


def _fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    votes, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held, owners, starts, n = [], [], [], 0

    def flush():
        nonlocal held, owners, starts, n
        if held:
            bits = np.unpackbits(np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes[owners] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        held, owners, starts, n = [], [], [], 0

    for i, text in enumerate(texts):
        for piece in _text_hashes(text, shingle):
            if n + len(piece) > FLUSH or (owners and owners[-1] == i):
                flush()
            owners.append(i)
            starts.append(n)
            held += piece
            n += len(piece)
            total[i] += len(piece)
    flush()
    bits = (2 * votes > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame, keep: list[Column], shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a bigint with the same bits."""
    rows = docs.select(*keep, whole_text().cast("binary").alias("__text"))
    names = [f for f in rows.schema.fields if f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            fps = pa.array(_fingerprints(texts, shingle), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in names), fps], [*(f.name for f in names), "fp"])

    schema = rows.drop("__text").schema.add("fp", "long")
    return rows.mapInArrow(run, schema)


def _tables(groups: int, max_distance: int) -> list[int]:
    """For each table the bits of its segments, as signed 64-bit masks."""
    segments = [list(s) for s in np.array_split(np.arange(32), groups)]
    masks = [sum(3 << (2 * int(s)) for s in g) for g in segments]
    full = [sum(c) for c in combinations(masks, groups - max_distance)]
    return [m - (1 << 64) if m >> 63 else m for m in full]


def _unary(fp: Column) -> Column:
    """Each two-bit segment's count in unary."""
    high = F.shiftrightunsigned(fp, 1)
    low = F.lit(LOW_BITS)
    return F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1).bitwiseOR(fp.bitwiseOR(high).bitwiseAND(low))


def _ones(words: np.ndarray) -> np.ndarray:
    """Set bits of each word (of a negative number numpy counts the absolute value's)."""
    return np.bitwise_count(words.view(np.uint64))


def _forest(fp: np.ndarray, count: np.ndarray, d: int) -> Iterator[tuple[int, int]]:
    """Links that join all members of a cell which links of at most ``d`` bits join."""
    left = np.arange(len(fp))
    while len(left):
        reach, left = [left[0]], left[1:]
        while reach and len(left):
            x = reach.pop()
            near = _ones(count[left] ^ count[x]) <= d
            at = left[near]
            at = at[_ones(fp[at] ^ fp[x]) <= d]
            if len(at):
                yield from ((int(fp[x]), int(fp[y])) for y in at)
                reach += at.tolist()
                left = left[~np.isin(left, at, assume_unique=True)]


def _cell_links(cells: list[str], d: int):
    """Over rows grouped by ``cells`` within a partition: the links of each cell."""
    def links(cell: np.ndarray, fp: np.ndarray, count: np.ndarray) -> pd.DataFrame:
        edge = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(axis=1)])
        size = np.diff(np.r_[edge, len(fp)])
        of = np.repeat(size, size)
        found: list[np.ndarray] = []
        small = of <= 64
        place = np.arange(len(fp)) - np.repeat(edge, size)
        for step in range(1, int(size[size <= 64].max(initial=0))):
            i = np.flatnonzero(small & (place + step < of))
            i = i[_ones(count[i] ^ count[i + step]) <= d]
            i = i[_ones(fp[i] ^ fp[i + step]) <= d]
            if len(i):
                found.append(np.c_[fp[i], fp[i + step]])
        for a, n in zip(edge[size > 64], size[size > 64]):
            found += [np.array([x]) for x in _forest(fp[a:a + n], count[a:a + n], d)]
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0) if found else np.empty((0, 2), np.int64)
        return pd.DataFrame(_spanning(pairs), columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[cells].to_numpy()
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut == 0 and held and (held[-1][cells].to_numpy()[-1] == keys[-1]).all():
                held.append(batch)
                continue
            done = pd.concat([*held, batch[:cut]]) if held else batch[:cut]
            held = [batch[cut:]]
            if len(done):
                yield links(done[cells].to_numpy(), done["fp"].to_numpy(), done["u"].to_numpy())
        if held:
            done = pd.concat(held)
            yield links(done[cells].to_numpy(), done["fp"].to_numpy(), done["u"].to_numpy())
    return run


def _spanning(pairs: np.ndarray) -> np.ndarray:
    """Of these links, as many as are needed to join the same nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    kept = []
    for i, (a, b) in enumerate(pairs.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(i)
    return pairs[kept]


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, groups: int = GROUPS, max_cell: int = MAX_CELL) -> DataFrame:
    """Links (a, b) between the distinct bigints ``fp`` that join all which
    links of at most ``max_distance`` differing bits join."""
    if groups <= max_distance:
        raise ValueError("more groups than differing bits are needed")
    u = _unary(F.col("fp"))
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("u").bitwiseAND(F.lit(m)).alias("cell"))
                       for t, m in enumerate(_tables(groups, max_distance))])
    dealt = fps.select("fp", u.alias("u")).select("fp", "u", F.explode(tables).alias("x")).select("fp", "u", "x.*")
    dealt = dealt.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("t", "cell"))).where("n > 1")
    few = dealt.where(F.col("n") <= max_cell).drop("n")
    blocks = F.ceil(F.col("n") / max_cell).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    many = (dealt.where(F.col("n") > max_cell).select("t", "cell", "fp", "u", own.alias("own"), blocks.alias("blocks"))
            .select("t", "cell", "fp", "u", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("t", "cell", "fp", "u", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    split = many.repartition("t", "cell", "i", "j").sortWithinPartitions("t", "cell", "i", "j")
    return (few.mapInPandas(_cell_links(["t", "cell"], max_distance), "a long, b long")
            .unionByName(split.mapInPandas(_cell_links(["t", "cell", "i", "j"], max_distance), "a long, b long")))


def groups_of(marked: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root, component_id) of the fingerprints in ``marked`` (doc_id, fp)."""
    fps = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = components(links(fps.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    # The roots hold linked fingerprints only; any other is its own component.
    linked = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = linked.where("root <> fp").groupBy("root").agg(F.min("first_id").alias("other_id"))
    least = (fps.select(F.col("fp").alias("root"), "first_id").join(ids, "root", "left")
             .select("root", F.least("first_id", "other_id").alias("component_id")))
    return linked.select("fp", "root").join(least, "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of ``docs``."""
    marked = written(fingerprints(docs, [F.col("doc_id")], shingle), "simhash")
    found = marked.join(groups_of(marked, max_distance), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The row with the smallest id of each group, in the columns of ``docs``
    (of rows with the same id and text, one)."""
    marked = written(fingerprints(docs, [F.col("doc_id"), F.xxhash64(whole_text()).alias("content")], shingle), "simhash")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("content").alias("content"))
    first = (marked.join(groups_of(marked, max_distance), "fp").groupBy("root").agg(F.min(rank).alias("first"))
             .select("first.id", "first.content"))
    chosen = written(first, "simhash-chosen")
    here = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64(whole_text()).alias("content"))
    mine = here.alias("h").join(chosen.alias("c"), F.col("h.id").eqNullSafe(F.col("c.id"))
                                & (F.col("h.content") == F.col("c.content")), "left_semi")
    once = Window.partitionBy("id", "content").orderBy(F.xxhash64("row"))
    return mine.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("row.*")
