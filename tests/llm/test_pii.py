import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from chronoledger.llm import pii

SCHEMA = "doc_id long, text string"
FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    """The contract's spans, by plain patterns."""
    out = []
    for kind, pattern in FORMS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def told(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(docs, rows):
    assert len(rows) == len(docs)
    want = sorted((str(i), told(base(t)), t) for i, t in docs)
    for (i, spans, t), r in zip(want, sorted(rows, key=lambda r: (str(r.doc_id), own(r)))):
        assert (i, spans) == (str(r.doc_id), own(r)), t
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [spans.count(f"{k}:") for k in FORMS]


def own(r):
    return ",".join(s for s in r.spans.split(",") if s.split(":")[0] in FORMS)


def twin(spark, docs, sql=pii.ORACLE_SQL):
    con = duckdb.connect()
    table = spark.createDataFrame(docs, SCHEMA).toArrow()
    con.register("documents", table)
    return sorted(map(str, con.sql(sql).fetchall()))


def same_as_sql(spark, docs, rows):
    assert sorted(str((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans, r.n_added)) for r in rows) == twin(spark, docs)


ODD = [None, "", "a@b.c_d@e.f @x.y a@b a@b..c a.b@c-d.e.f, é@b.cc x@é.com", "1.2.3.4.5.6.7.8 256.1.1.1 0001.0255.3.4 1.2.3 01.02.03.004.",
       "4111 1111 1111 1111 4111-1111-1111-1111-0 4111 1111 1111 1112 411111111111111111110", "+1 (736) 555-2678 4663622617512349 +12 34 56 78 +1-2 +1234567 +123456789012345 +1234567890123456 +1()2",
       "+" * 50 + "1" * 9, "𝒳 a@b.cc 😀 1.2.3.4 \n+49 30 1234567\x00x@y.zz", "1" * 30_000, "a" * 30_000 + "@" + "b." * 10_000 + "c", "1." * 20_000, "1 " * 20_000, "+1" + " " * 20_000]


def test_base_spans_by_brute_force(spark):
    rng = random.Random(2)
    docs = list(enumerate(ODD)) + [(None, ODD[2]), (3, ODD[3]), (3, ODD[3])]
    docs += [(100 + i, "".join(rng.choices(["a", "@", ".", "-", "+", "1", "4111111111111111", "25", " ", "(", ")", "_", "é", "\n"], k=rng.randint(0, 40)))) for i in range(400)]
    rows = pii.scan(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()
    check(docs, rows)
    same_as_sql(spark, docs, rows)


def people(seed=1):
    """Texts with data that lists and contexts give away, and look-alikes."""
    rng = random.Random(seed)
    fill = ["the report was late", "we went there", "see chapter four", "it rained all day"]
    docs = []
    for i in range(150):
        lines = [rng.choice(fill) + "." for _ in range(4)]
        k = i % 5
        if k == 0:
            lines[1] = f"{rng.choice(['Contact:', 'Name:', 'signed'])} {rng.choice(pii.GIVEN)} {rng.choice(['Smith', 'Baker', 'Gomez'])}, tel: 0{rng.randint(20, 99)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}."
        elif k == 1:
            lines[2] = f"ssn: {rng.randint(100, 599)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} and IBAN: DE{rng.randint(10, 99)} 3704 0044 0532 0130 00 at x{i}@mail.example."
        elif k == 2:
            lines[0] = rng.choice(["See The Apache License or the General Public License", "In the Big Hall of North Bank", "Erthintion Erthintion"])
            lines[3] = f"version {rng.randint(10, 99)}.{rng.randint(100, 999)}.{rng.randint(1000, 9999)} order 9{rng.randint(10, 99)}-00-0000."
        docs.append((i, "\n".join(lines)))
    return docs


def test_added_spans(spark):
    docs = people()
    rows = pii.scan(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()
    check(docs, rows)
    for r in rows:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        if r.doc_id % 5 == 0:
            assert kinds == ["name", "tel"], (dict(docs)[r.doc_id], r.spans)
        elif r.doc_id % 5 == 1:
            assert kinds == ["email", "ssn", "iban"], (dict(docs)[r.doc_id], r.spans)
        else:
            assert not kinds, (dict(docs)[r.doc_id], r.spans)
    same_as_sql(spark, docs, rows)


def test_expectation_maximisation_by_brute_force(spark):
    """Reliabilities of three labelers of known quality are found, as a plain loop finds them."""
    rng = random.Random(4)
    rows = []
    for _ in range(4000):
        y = rng.random() < 0.3
        votes = [f"{g}:{(1 if y == (rng.random() < q) else -1) if rng.random() < 0.8 else 0}" for g, q in zip(pii.LABELERS, (0.9, 0.8, 0.75, 0.6, 0.55))]
        rows.append((4, votes, 1, y))
    table = spark.createDataFrame(rows, "rank int, votes array<string>, n long, y boolean")
    patterns = table.groupBy("rank", "votes").agg(F.sum("n").alias("n"))
    model = pii.fit_votes(patterns.checkpoint())
    posterior = {}
    for _, votes, _, _ in rows:
        posterior.setdefault(tuple(votes), 1 / (1 + 2.718281828459045 ** -(2 * sum(int(v.split(":")[1]) for v in votes) - 1)))
    for _ in range(pii.ROUNDS):
        yes = sum(posterior[tuple(v)] for _, v, _, _ in rows)
        share = {}
        for g in pii.LABELERS:
            for v in (-1, 0, 1):
                a = sum(posterior[tuple(x)] for _, x, _, _ in rows if f"{g}:{v}" in x)
                b = sum(1 - posterior[tuple(x)] for _, x, _, _ in rows if f"{g}:{v}" in x)
                share[f"{g}:{v}"] = (a + pii.PRIOR[True][v]) / (yes + 4.5), (b + pii.PRIOR[False][v]) / (len(rows) - yes + 4.5)
        for votes in posterior:
            x, z = yes + 1, len(rows) - yes + 1
            for v in votes:
                x, z = x * share[v][0], z * share[v][1]
            posterior[votes] = x / (x + z)
    got = {tuple(r.votes): r.p for r in patterns.select("votes", model.probability(F.col("rank"), F.col("votes")).alias("p")).collect()}
    assert all(got[v] == pytest.approx(p, abs=1e-9) for v, p in posterior.items())
    assert sum((posterior[tuple(v)] > 0.5) == y for _, v, _, y in rows) / len(rows) > 0.85


def test_empty_table_and_extra_columns(spark):
    empty = pii.scan(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    docs = people(3)[:10]
    wide = spark.createDataFrame(docs, SCHEMA).select("*", *[F.lit(5).alias(c) for c in ("t", "base", "weak", "spans", "rank", "start", "m", "votes", "c", "n")])
    check(docs, pii.scan(wide).collect())


def test_runs_to_redact(spark):
    row = pii.redacted(spark.createDataFrame([(1, "x +49 30 1234567 and a@b.cc")], SCHEMA)).first()
    assert [tuple(r) for r in row.runs] == [(2, 16), (21, 27)]
