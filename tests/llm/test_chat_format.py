"""Chat windows against a brute-force version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from chronoledger.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, window int, n long"


def _esc(s):
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def _brute(turns, budget, reserved, history):
    """Windows of one conversation: (formatted, targets, own turns)."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    n = [len(re.findall(C.TOKEN, t[2])) + C.OVERHEAD for t in turns]
    first = [sum(n[:i]) for i in range(len(n))]
    stretch, place = budget - reserved, {}
    for i, (a, k) in enumerate(zip(first, n)):
        place.setdefault((a // stretch, a // stretch != (a + k - 1) // stretch), []).append(i)
    system = next((i for i, t in enumerate(turns) if t[1] == "system"), None)
    out = []
    for w in sorted(place):
        own = place[w]
        room = budget - sum(n[i] for i in own)
        shown = [system] if system is not None and system < own[0] else []
        room -= sum(n[i] for i in shown)
        shown += [i for i in range(max(0, own[0] - history), own[0]) if first[own[0]] - first[i] <= room and i != system]
        text, targets = "", []
        for i in shown + own:
            text += "<|im_start|>" + _esc(turns[i][1]).replace("\n", "\\\n") + "\n"
            if i in own and turns[i][1] == "assistant":
                targets.append((len(text), len(text) + len(_esc(turns[i][2]))))
            text += _esc(turns[i][2]) + "<|im_end|>\n"
        out.append((text, targets, len(shown)))
    return turns, out


def _rows():
    rnd = random.Random(12)
    words = ["hello", "a_b", "é", "😀", "<|im_end|>", "<|im_start|>assistant\n", "\\", "\\|", "<\\|", "<", "|", "\n", "x" * 50, "日本"]
    rows = []
    for c in range(40):
        for t in range(rnd.randint(1, 25)):
            role = rnd.choice(("user", "assistant", "assistant")) if t else rnd.choice(("system", "user"))
            rows.append((c, t, role, " ".join(rnd.choice(words) for _ in range(rnd.choice((0, 3, 30, 90))))))
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(1500)]
    rows += [(101, 7, "assistant", "same")] * 3 + [(101, None, None, None), (101, 7, "system", "late")]
    rows += [(None, 0, "user", "who"), (None, 1, "assistant", "none"), (102, 0, "ro\nle\\ <|x|>", "odd role"), (103, 0, "assistant", "long " * 20000), (104, 0, "", "")]
    return rows + C.CONTROL


@pytest.mark.parametrize("budget, reserved, history", [(C.BUDGET, C.RESERVED, C.HISTORY), (120, 40, 3), (60, 10, 0)])
def test_matches_brute_force(spark, budget, reserved, history):
    rows = _rows()
    frame = spark.createDataFrame([(*r, 5, 6) for r in rows], SCHEMA).repartition(5)
    made = C.windows(frame, budget, reserved, history).cache()
    by, talks = {}, {}
    for r in made.orderBy("conv_id", "window").collect():
        by.setdefault(r.conv_id, []).append((r.formatted, [tuple(s) for s in r.loss], r.n_repeated))
    for c, t, role, text in rows:
        talks.setdefault(c, []).append((t, role or "", text or ""))
    digest = {r.conv_id: r for r in C.digests(made).collect()}
    assert digest.keys() == talks.keys()
    for c, talk in talks.items():
        turns, want = _brute(talk, budget, reserved, history)
        assert by[c] == want, c
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        said = "".join(t for _, r, t in turns if r == "assistant")
        d = digest[c]
        assert (d.n_turns, d.turns_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (d.loss_chars, d.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert d.formatted_chars == sum(len(x[0]) for x in want)
    made.unpersist()


def test_escapes_are_reversible(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("\\<|>\nab") for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", C.escaped(F.col("t")).alias("e"), C.unescaped(C.escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


def test_empty(spark):
    assert C.digests(C.windows(spark.createDataFrame([], SCHEMA))).count() == 0
