"""Token counts against the library."""

import random

import pytest

from chronoledger.llm import token_count as T

VOCABULARY = "byte_bpe_50k.json"
ODD = ["", " ", "\n", "  ", " a", "a ", "a\n", "a\n\nb", "a \nb", "a\n b", "x  y", "tab\there", "don't we'll I'm 'S", "<|endoftext|>", "a<|endoftext|> b",
       "<|endoftext|><|endoftext|>\n<|endo", "áb é. ́x", "½² 12x _a_", "a b c\x1cd\x85e　f", "हिन्दी क़ 日本語。テスト", "😀😀 👩‍👩‍👧", "x" * 3000, "ab" * 2000,
       " " * 500, "word " * 20000, "a.\nB c,\nd", "İstanbul ſtraße K", "\r\nline\r\n", "\x00\x01", "  leading", "trailing  ", " x​"]


@pytest.fixture(scope="module")
def tools():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(VOCABULARY)
    return T.Counter(path), Tokenizer.from_file(path)


def _library(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ODD, ids=range(len(ODD)))
def test_odd_texts(tools, text):
    assert tools[0](text) == _library(tools[1], text)


def test_random_texts(tools):
    rnd = random.Random(4)
    for _ in range(1500):
        text = "".join(rnd.choice("aAbetn  '.,1é\n\t-日s") for _ in range(rnd.randint(0, 60)))
        assert tools[0](text) == _library(tools[1], text), repr(text)


def test_lowest_rank_first():
    rank = {("a", "b"): 2, ("b", "c"): 0, ("a", "bc"): 1}
    assert T.count_merged(list("abc"), rank) == 1 and T.count_merged(list("abab"), rank) == 2
    assert T.count_merged(list("aaa"), {("a", "a"): 0}) == 2 and T.count_merged(["a"], rank) == 1


def test_whole_table_and_odd_rows(spark, sf, tools):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(9000 + i, t) for i, t in enumerate(ODD)] + [(None, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, n_bytes int, n_tokens int")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in T.count_tokens(docs).collect())
    want = []
    for d, t in rows:
        n = _library(tools[1], t)
        want.append((str(d), len((t or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert T.count_tokens(docs.where("false")).count() == 0


def test_forgetting_changes_nothing(tools, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 2)
    assert [tools[0]("the cat sat\non the mat") for _ in range(5)] == [_library(tools[1], "the cat sat\non the mat")] * 5
