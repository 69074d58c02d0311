"""Quality rules against a brute-force version."""

import random
import re
from collections import Counter

from chronoledger.llm import quality as Q

SPACES = " \t\n\x0b\f\r"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def _line_fails(line):
    n = len(_words(line))
    if not n:
        return False
    seps, symbols, shouts = (len(re.findall(p, line)) for p in (Q.SEPARATOR, Q.SYMBOLS, Q.SHOUT))
    return ((seps >= 1 and seps * 100 >= n * Q.NAV_PERCENT) or (symbols >= 3 and symbols * 100 >= n * Q.SYMBOL_PERCENT)
            or (shouts >= 3 and shouts * 100 >= n * Q.SHOUT_PERCENT)
            or (n < Q.OPEN_LINE_WORDS and not re.search(Q.CLOSED, line.rstrip(SPACES)))
            or (n < Q.BOILERPLATE_WORDS and re.search(Q.BOILERPLATE, line.lower()) is not None))


def _brute(text):
    text = text or ""
    words, lines = _words(text), text.split("\n")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    full = [x for x in lines if _words(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    cleaned = "\n".join(x for x in lines if not _line_fails(x))
    chars, left = sum(map(len, words)), sum(map(len, _words(cleaned)))
    return (len(words), chars, len(re.findall(Q.SYMBOLS, text)), len(full) - len(set(full)), len(covered), failed,
            not failed and left * 100 >= chars * Q.MIN_LEFT_PERCENT, sum(map(_line_fails, lines)), left, cleaned)


def _texts():
    rnd = random.Random(9)
    words = ["the", "a", "cat", "sat", "mat.", "été", "日本", "x,", "(no)", "#tag", "***", "|", "!!", "end.", "😀", " ", "\x1c"]
    lines = ["home | about | news", "We use cookies, see our cookie policy", "THE!! END!! NOW!!", "Title", "Short one.", "", "   ", "read more", "Terms of Service apply here."]
    texts = []
    for _ in range(250):
        texts.append("\n".join(rnd.choice(lines) if rnd.random() < 0.3 else rnd.choice((" ", "  ", "\t")).join(
            rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 8))))
    prose = " ".join(f"word{i}" for i in range(50)) + "."
    return texts + [None, "", "\n\n\n", "one", "same " * 50, prose, prose + "\n" + prose, prose + "\nhome | news", "\n".join(["nav | bar | x"] * 9) + "\n" + prose,
                    " ".join(f"w{i}" for i in range(20000)), "a b c d e " * 4000, "x" * 100000, "word1 word2 word3 word4 word5"]


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 7, 1, 2) for i, t in texts],
                                 "doc_id long, text string, lang string, kept string, n_chars long, ws int, cleaned int").repartition(4)


def test_matches_brute_force(spark):
    texts = list(enumerate(_texts())) + [(None, "one two"), (3, "again"), (3, "again")]
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in Q.assess(_docs(spark, texts)).collect())
    assert got == sorted((str(i), *_brute(t)) for i, t in texts)
    assert {True, False} == {r[7] for r in got}


def test_clean_keeps_columns_and_cleaned_texts(spark):
    texts = list(enumerate(_texts()))
    docs = _docs(spark, texts)
    cleaned = Q.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.dtypes == docs.dtypes
    want = {i: _brute(t)[-1] for i, t in texts if _brute(t)[6]}
    rows = cleaned.collect()
    assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
    assert Q.clean(docs.where("false")).count() == 0 and Q.assess(docs.where("false")).count() == 0


def test_good_documents_are_kept(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.assess(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").collect()
    assert all(r.kept or r.base_failed for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in rows)
