import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronoledger.llm import queries, spelling

SCHEMA = "doc_id long, text string"


def vocabulary(docs):
    seen = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'none' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def edits(word, letters):
    for k in range(len(word) + 1):
        yield from (word[:k] + c + word[k:] for c in letters)
        if k < len(word):
            yield word[:k] + word[k + 1:]
            yield from (word[:k] + c + word[k + 1:] for c in letters)


def brute(words):
    letters = sorted(set("".join(words)))
    out, form = {}, {}
    for w, n in words.items():
        near = {x for x in edits(w, letters) if x != w and x in words}
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
        out[w] = [n, len(near)]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w], words.get(form[w]))
    return out


def told(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def made(seed, n_docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abéÿ×" if k % 5 == 0 else "abcd", k=rng.randint(4, 9))) for k in range(80)]
    base += [w[:k % 4] + rng.choice("abcé") + w[k % 4 + k % 2:] for k, w in enumerate(base[:40] * 2)]
    docs = []
    for i in range(n_docs):
        words = rng.choices(base, weights=[1 / (k % 80 + 4) for k in range(len(base))], k=60)
        docs.append((i % 50 if i % 7 else None, " ".join(w.upper() if rng.random() < .1 else w for w in words)))
    return docs + [(900, None), (901, ""), (902, "12 Ā a")] + [(7, docs[7][1])] * 3


@pytest.mark.parametrize("limits", [{}, {"cell_bytes": 2000, "cell_queries": 20}, {"cell_bytes": 1000, "cell_queries": 9, "sample": 30}])
def test_brute_force(spark, limits):
    docs = made(len(limits))
    want = brute(vocabulary(docs))
    got = told(spelling.variants(spark.createDataFrame(docs, SCHEMA).repartition(4), **limits))
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 5 and max(v[3] for v in want.values()) > 2


def test_query_on_given_table(spark):
    got = told(queries.op11_spelling(spark, "/root/testdata/sf0.001"))
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got == brute(vocabulary(docs)) and len(got) > 500


def test_chains_of_forms(spark):
    """A form can have a form: the root is the last, and ties go to the smaller word."""
    n = {"abcdefg": 3, "abcdef": 6, "abcde": 12, "xbcde": 24, "abcdx": 24, "zzzzzz": 3, "zzzzzy": 5}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    found = spelling.forms(words, spelling.near_pairs(words))
    got = {r.word: (r.form, r.n_near) for r in found.collect()}
    assert got == {"abcdefg": ("abcdef", 1), "abcdef": ("abcde", 2), "abcde": ("abcdx", 3), "xbcde": (None, 1), "abcdx": (None, 1),
                   "zzzzzz": (None, 1), "zzzzzy": (None, 1)}
    assert {r.word: r.root for r in spelling.roots(found).collect()} == {"abcdefg": "abcdx", "abcdef": "abcdx", "abcde": "abcdx"}


def test_edits_in_order_of_letters():
    def letters(words):
        return spelling._letters(words).T
    assert spelling.one_replaced(letters(["abcde", "abcde", "abcde"]), letters(["abcxe", "edcba", "abcde"])).tolist() == [True, False, False]
    assert spelling.one_inserted(letters(["abab"] * 5), letters(["xabab", "aabab", "ababx", "abxba", "baabb"])).tolist() == [True, True, True, False, False]


def test_trees_reach_all_that_is_near():
    rng = np.random.default_rng(1)
    rows = np.zeros((500, spelling.DIMENSIONS), np.int16)
    rows[:, :6] = rng.integers(0, 4, size=(500, 6))
    rows[300:, 9] = rng.integers(0, 2, size=200)  # a letter that the tree's rows don't have
    far = np.abs(rows[:, None, :] - rows[None]).sum(axis=2)
    for radius in (1, 2):
        same = radius == 2
        asked = rows if same else np.maximum(rows - (rng.integers(0, 12, size=rows.shape) == 0), 0)
        found = [x for q, m in spelling.Tree(rows[:300], leaf=4).near(asked, same) for x in zip(q.tolist(), m.tolist())]
        up, down = rows[None, :300] - asked[:, None], asked[:, None] - rows[None, :300]
        want = (np.maximum(up, 0).sum(axis=2) <= 1) & (np.maximum(down, 0).sum(axis=2) <= same)
        ranks = spelling.rank(rows)
        want &= ranks[:, None] < ranks[None, :300] if same else True
        assert set(zip(*map(np.ndarray.tolist, np.nonzero(want & (np.abs(up).sum(axis=2) == radius))))) <= set(found)
        assert len(set(found)) == len(found) and all(np.abs(up[x]).sum() <= radius for x in found)
        top = spelling.TopTree(rows[:80], 8)
        home = {i: leaf for leaf, at in top.placed(rows, 0) for i in at.tolist()}
        assert len(home) == 500 and sum(len(at) for _, at in top.placed(rows, 0)) == 500
        reach = {(i, leaf) for leaf, at in top.placed(rows, radius) for i in at.tolist()}
        assert reach >= {(q, home[m]) for q, m in zip(*map(np.ndarray.tolist, np.nonzero(far <= radius)))}


def test_codes_differ_in_as_many_bits_as_letters():
    rng = np.random.default_rng(2)
    rows = np.zeros((300, spelling.DIMENSIONS), np.int16)
    rows[:, 3:30] = rng.integers(0, 5, size=(300, 27))
    far = np.abs(rows[:, None, :] - rows[None]).sum(axis=2)

    def bits(tree):
        codes = tree._codes(rows)
        return np.bitwise_count(codes[:, :, None] ^ codes[:, None]).sum(axis=0)
    assert (bits(spelling.Tree(rows)) == far).all()
    rows[:, 40:44] = rng.integers(0, 1000, size=(300, 4))  # more values than bits
    far = np.abs(rows[:, None, :] - rows[None]).sum(axis=2)
    tree = spelling.Tree(rows)
    assert (bits(tree) <= far).all() and (bits(tree) > 2).sum() > 300 * 298 and len(tree.thresholds) <= 27 * 4 + 4 * spelling.STEPS


def test_trees_over_many_values_lose_nothing():
    """Counts of long words, above, below and among those of the tree; a value that most rows share."""
    rng = np.random.default_rng(3)
    rows = np.zeros((400, spelling.DIMENSIONS), np.int16)
    rows[:, :3] = rng.integers(5, 900, size=(400, 3))
    rows[:, 3] = np.where(rng.integers(0, 20, size=400) == 0, rng.integers(5, 900, size=400), 900)
    asked = np.repeat(rows, 8, axis=0)
    for k, q in enumerate(asked):  # one letter less, and one of another kind more or less
        q[rng.integers(0, 4)] -= 1
        if k % 2:
            q[rng.integers(0, 5)] += 1
    home = np.repeat(np.arange(400), 8)
    tree = spelling.Tree(rows, leaf=16)
    for same in (False, True):
        kept = np.flatnonzero(np.arange(len(asked)) % 2 == same)
        found = {(int(kept[q]), int(x)) for qs, m in tree.near(asked[kept], same) for q, x in zip(qs, m)}
        ranks = spelling.rank(asked), spelling.rank(rows)
        wanted = {(int(q), int(home[q])) for q in kept if not same or ranks[0][q] < ranks[1][home[q]]}
        assert len(wanted) > 400 and wanted <= found and len(found) < 2 * len(wanted)


def test_a_cell_gives_its_pairs_in_few_batches():
    """Pairs aren't handed out leaf by leaf: each batch costs both sides of the pipe."""
    words = sorted({f"{a}{b}{c}{d}" for a in "abcdef" for b in "ghijkl" for c in "mnopqr" for d in ("tuvwx", "xwvut", "yyyyy", "zzyzz")})
    n = len(words)

    def batch(query):
        return pa.RecordBatch.from_arrays([*[pa.array(np.full(n, 8, np.int32))] * 4, pa.array(np.full(n, query)), pa.array(words), pa.array(np.arange(n))],
                                          ["length", "leaf", "part", "share", "query", "word", "n"])
    given = list(spelling._searched(iter([batch(False), batch(True)])))
    pairs = [tuple(sorted((r["a"], r["b"]))) for g in given for r in g.to_pylist()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if a < b and sum(x != y for x, y in zip(a, b)) == 1)
    assert len(given) <= len(pairs) / spelling.BATCH + 1


def test_long_words_ties_and_hubs(spark):
    long = "ab" * 20_000
    words = {long: 4, long[:-1]: 9, long + "c": 3, "hubby": 100, **{f"hub{chr(0x61 + k)}y": 3 for k in range(26) if k != 1}, **{f"hubb{chr(0xE0 + k)}": 3 for k in range(20)}}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.form, r.n_near) for r in spelling.forms(table, spelling.near_pairs(table)).collect()}
    want = {w: (f, k) for w, (f, _, _, k, _) in brute({w: n for w, n in words.items() if len(w) < 100}).items()}
    assert {w: v for w, v in got.items() if len(w) < 100} == want
    assert got[long] == (long[:-1], 2) and got[long + "c"] == (None, 1) and got[long[:-1]] == (None, 1)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(empty).count() == 0
    docs = made(5, 20)
    wide = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("word", "n", "run", "h", "id", "form", "root", "a", "b", "length", "leaf")])
    assert told(spelling.variants(wide)) == brute(vocabulary(docs))
