"""License scan against a brute-force version."""

import itertools
import math
import random
import re

import pytest

from chronoledger.llm import license_scan as L
from chronoledger.llm.license_rules import pattern, rules


def _words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _brute(text):
    words = _words(text)
    normal = "".join(f" {w} " for w in words)
    found = []
    for k, r in enumerate(rules()):
        for m in re.finditer(pattern(r.words), normal):
            a, b = normal[:m.start()].count(" ") // 2, normal[:m.end()].count(" ") // 2
            found.append((a, b, r.priority, k, r.label, r.confidence))
    kept = [x for x in found if not any(
        y[0] <= x[0] and y[1] >= x[1] and (y[2] > x[2] or y[2] == x[2] and (y[1] - y[0] > x[1] - x[0] or y[:2] == x[:2] and y[3] < x[3]))
        for y in found)]
    base = []
    for phrase, label in L.BASE.items():
        p = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    labels = sorted({x[4] for x in kept} | {b[1] for b in base})
    score = max([0.5 if base else 0.0, *(x[5] for x in kept)])
    return (len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
            ",".join(sorted({b[1] for b in base})), ",".join(labels), score, sorted((x[0], x[1], x[4]) for x in kept))


def _texts():
    rnd = random.Random(8)
    vocabulary = sorted({w.strip("()?") for r in rules() for w in r.words.split() if re.fullmatch(r"\(?[a-z0-9]+\)?\??", w)})
    whole = [re.sub(r"\(([a-z0-9|]+)\)\??", lambda m: m[1].split("|")[0], r.words).replace("licen[sc]e", "license").replace("[1-4] [05]", "4 0")
             for r in rules() if "~" not in r.words and "[0-9]" not in r.words and "(?:" not in r.words]
    texts = [w.title() + "." for w in whole]
    for _ in range(150):
        texts.append(rnd.choice((" ", ", ", "\n")).join(rnd.choice((rnd.choice(vocabulary), rnd.choice(whole), rnd.choice(vocabulary))) for _ in range(rnd.randint(1, 60))))
    texts += [None, "", "...", "cc by cc by cc-by", "CC BY", "occ by", "ccby", "All Rights Reserved\nall rights reserved", "é licence 日本", "mit Lizenz und mit Recht",
              "license " * 3000, "apache license " * 400, "General  Public--License"]
    return texts


def _rows(frame):
    return sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels, r.labels, r.score,
                   sorted((d.start, d.end, d.label) for d in r.detections)) for r in frame.collect())


def test_matches_brute_force(spark):
    texts = list(enumerate(_texts())) + [(None, "all rights reserved"), (4, "cc by"), (4, "cc by")]
    docs = spark.createDataFrame([(d, t, "l", 1, 2.0) for d, t in texts], "doc_id long, text string, labels string, found int, score double").repartition(6)
    want = []
    for d, t in texts:
        b = _brute(t)
        want.append((str(d), b[0], b[1], str(b[2]), str(b[3]), *b[4:]))
    assert _rows(L.scan(docs)) == sorted(want)
    assert L.scan(docs.where("false")).count() == 0


def test_rules_are_many_and_gated():
    own = rules()
    assert len(own) >= 200 and all(0 <= r.priority < L.PRIORITIES and 0 < r.confidence <= 1 for r in own)
    assert len({(r.label, r.words) for r in own}) == len(own)


@pytest.mark.parametrize("text", [t for t in _texts() if t][:-12])
def test_no_match_without_stem_or_keyword(text):
    normal = "".join(f" {w} " for w in _words(text))
    for r in rules():
        if re.search(pattern(r.words), normal):
            assert r.keyword in normal, r
            assert any(s in normal for s in L.STEMS), r


def _forms(parsed):
    """For each item of a parsed expression the texts that it can stand for (repeats at most twice)."""
    items = []
    for op, value in parsed:
        op = str(op)
        if op == "LITERAL":
            items.append([chr(value)])
        elif op == "NOT_LITERAL":
            items.append(["x"])
        elif op == "IN":
            items.append([chr(c) for kind, v in value for c in (range(v[0], v[1] + 1) if str(kind) == "RANGE" else [v])])
        elif op == "BRANCH":
            items.append([t for branch in value[1] for t in _texts_of(branch)])
        elif op == "SUBPATTERN":
            items.append(_texts_of(value[3]))
        elif op == "MAX_REPEAT":
            low, high, inner = value
            items.append([t * n for n in range(low, min(int(high), low + 1) + 1) for t in (_texts_of(inner) if n else [""])])
        else:
            raise ValueError(op)
    return items


def _texts_of(parsed):
    """All texts of an expression; of a long one, those with each form of each item among the first and the last forms of the others."""
    items = _forms(parsed)
    if math.prod(map(len, items)) <= 2000:
        return ["".join(t) for t in itertools.product(*items)]
    bases = [[forms[end] for forms in items] for end in (0, -1)]
    return ["".join([*base[:i], form, *base[i + 1:]]) for base in bases for i, forms in enumerate(items) for form in forms]


def test_keyword_and_stem_stand_in_every_form_of_a_rule():
    wrong = set()
    for r in rules():
        for text in _texts_of(re._parser.parse(pattern(r.words))):
            normal = f" {re.sub(' +', '  ', text.strip())} "
            assert re.search(pattern(r.words), normal), (r, text)
            if r.keyword not in normal or not any(s in normal for s in L.STEMS):
                wrong.add((r, normal))
    assert not wrong


@pytest.mark.parametrize("last", ["permission", "consent"])
def test_notice_without_prior_written(spark, last):
    docs = spark.createDataFrame([(1, f"No copies without the prior written {last}.")], "doc_id long, text string")
    row = L.scan(docs).first()
    assert (row.labels, row.score, [(d.start, d.end) for d in row.detections]) == ("proprietary", 0.7, [(2, 7)])
