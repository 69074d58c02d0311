"""The pipeline against brute force, stage by stage and whole."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P


def _source(i):
    return "rare" if i % 17 == 5 else f"s{i % 3}"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    words = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "nu", "ra", "si", "to") for b in ("ba", "ke", "lo", "mi", "nu", "ra", "si", "to", "n", "r")]

    def prose(n):
        return " ".join(" ".join(rnd.choice(words) for _ in range(9)).capitalize() + "." for _ in range(n // 9))
    items = [(i, prose(30)) for i in range(5)]
    texts = [prose(rnd.choice((60, 200, 500))) for _ in range(60)]
    texts += [texts[3], texts[3].upper(), texts[4] + " Again.", prose(90) + "\n" + items[2][1] + "\n" + prose(90),
              "home | about | news | shop | help", prose(120) + "\nhome | about | news | help", "short", "", None, " ".join(["same"] * 80)]
    path = tmp_path_factory.mktemp("corpus")
    rows = [(i, t, "en", _source(i), len(t or "")) for i, t in enumerate(texts)] + [(3, texts[3], "en", _source(3), 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def _library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = P.quality_rules(spark, docs, folder)
    assert first.columns == docs.columns
    good = {r.doc_id: r.text for r in first.collect()}
    assert not {64, 66, 67, 68, 69} & set(good)
    assert "home" not in good[65] and good[65].count(".") > 5
    second = P.simhash_near_dedup(spark, first, folder).collect()
    ids = [r.doc_id for r in second]
    assert len(ids) == len(set(ids)) and 3 in ids and 60 not in ids and 61 not in ids
    third = P.benchmark_decontamination(spark, spark.createDataFrame(second, docs.schema), folder)
    assert set(ids) - {r.doc_id for r in third.collect()} == {63}


def _copies(rows):
    """How many copies the mixing stage gives each of ``rows`` (id, text), by a plain fit."""
    def topic(t):
        if re.search("licen[sc]e|rights reserved", t.lower()):
            return "legal"
        if t.count("|") >= 5:
            return "listing"
        return "data" if len(re.findall("[0-9]", t)) * 20 >= len(t) else "note" if len(t) < 600 else "prose"
    cell = {i: (_source(i), "en", topic(t)) for i, t in rows}
    n = Counter()
    for i, t in rows:
        n[cell[i]] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    share = {c: float(x) for c, x in n.items()}
    goals = []
    for k, power in enumerate((0.5, 0.7, 0.9)):
        own = Counter()
        for c, x in n.items():
            own[c[k]] += x
        goals.append({x: v ** power / sum(y ** power for y in own.values()) for x, v in own.items()})
    for _ in range(300):
        for k, goal in enumerate(goals):
            sums = Counter()
            for c, x in share.items():
                sums[c[k]] += x
            share = {c: x * goal[c[k]] / sums[c[k]] for c, x in share.items()}
    out = {}
    for i, _ in rows:
        weight = round(0.7 * share[cell[i]] * sum(n.values()) / n[cell[i]], 9)
        u = int(hashlib.md5(f"{i}:mix".encode()).hexdigest()[:8], 16) / 2 ** 32
        out[i] = int(weight) + (u < weight - int(weight))
    return out


def test_run_matches_plain_versions_of_all_stages(spark, folder):
    """Each stage by its own brute force; copies of documents whose weight is above 1 as well."""
    from tests.llm.test_decontaminate import _held
    from tests.llm.test_quality import _brute
    from tests.llm.test_simhash import _fingerprint, _groups

    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = sorted({(d.doc_id, _brute(d.text)[-1]) for d in docs if _brute(d.text)[6]})
    label = _groups([_fingerprint(t) for _, t in rows], 4)
    rows = [rows[i] for i in sorted(set(label))]
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    rows = [(i, t) for i, t in rows if all(_held(t, x.text) < 0.8 for x in items)]
    copies = _copies(rows)
    assert max(copies.values()) > 1 and min(copies.values()) == 0
    library, at, want = _library(), 0, []
    for i, t in rows:
        for _ in range(copies[i]):
            ids = library.encode(t, add_special_tokens=False).ids + [2]
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    assert sorted(tuple(r) for r in P.run(spark, folder).collect()) == want


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
