"""Personal data by weak supervision: labelers vote, expectation-maximisation
weighs them, a span classifier decides.

Base spans (e-mail and IP addresses, payment cards, international phone
numbers) are always reported. Candidates of further kinds (names of persons,
national phone numbers, social security numbers, bank accounts) are wide
patterns that mostly match other things. On each of them labelers vote 1, 0
(no opinion) or -1:

* ``form``: a regular expression of forms that can't be of the kind;
* ``gazetteer``: lists of given names, of country codes, of words no name has;
* ``before`` and ``after``: the words around the span;
* ``beside``: a base span within ``NEAR`` code points.

Votes are counted for each pattern of votes, of which there are at most 3^5
a kind, and expectation-maximisation estimates from these counts how often a
kind's candidates are personal data, and each labeler's votes given that they
are or are not (with prior counts, so that no vote is ever proof). The
posteriors then are the soft labels on which the final classifier, naive
Bayes over votes, lengths, and characters around the span, is trained. It
reports a candidate at a probability of ``SURE`` if the gazetteer or the words
around it speak for it: what no labeler knows by name is never reported.

Texts are read once. A row holds its spans, candidates and votes; nothing but
counts of patterns and features is shuffled, so hot sources, copies and
repeated names don't matter, and there is nothing to join. The driver holds the
model: a number for each kind and value of a vote or feature. Only built-in
functions are used.

Defined cases: a NULL text is empty; equal rows are each reported and count
each; a NULL doc_id stays; an empty table gives an empty result; spans are in
code points, end exclusive, and candidates that touch a base span are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import ascii_lower, let, running, whole_text, written

KINDS = ["email", "ip", "card", "phone", "name", "tel", "ssn", "iban"]
BASE, WEAK = KINDS[:4], KINDS[4:]
#: The base kinds.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "name": r"[A-Z][a-z\x{DF}-\x{FF}]+(?:[\x20-][A-Z][a-z\x{DF}-\x{FF}]+){1,2}",
    "tel": r"\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,6}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
}
#: The same matches without trying again inside a run of letters or digits: time stays linear in long runs.
LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
}
#: What a text must hold for a search to be worth it.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

GIVEN = """James Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Patricia
Jennifer Elizabeth Barbara Susan Jessica Sarah Margaret Dorothy Helen Hans Juergen Jürgen Wolfgang Klaus Dieter
Uwe Stefan Matthias Sabine Monika Ursula Petra Renate Heike Jean Pierre Michel Philippe Jacques François Nathalie
Isabelle Sylvie Catherine Françoise Jose José Antonio Manuel Francisco Javier Carlos Miguel Carmen Dolores Pilar
Josefa Rosario Fatima Mohammed Ahmed Ibrahim Olga Natalia Dmitri Sergei Giovanni Giuseppe Francesca Yuki Hiroshi""".split()
NO_NAME = """The Of And In On At By To For With From This That License Licence Public Apache General University Institute
Street Road Avenue Company Inc Ltd Foundation Project Software Copyright Rights January February March April June July
August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday""".split()
COUNTRIES = "AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IL IS IT LI LT LU LV MC MT NL NO PL PT RO RS SA SE SI SK SM TR".split()
TITLES = "mr|mrs|ms|dr|prof|professor|herr|frau|monsieur|madame|don|dona|sir|name|name is|named|contact|author|signed|dear|attn"

LABELERS = ["form", "gazetteer", "before", "after", "beside"]
#: For each kind and labeler: the text it reads, what speaks against and what for the kind (None: nothing).
VOTES: dict[str, dict[str, tuple[str, str | None, str | None]]] = {
    "name": {
        "form": ("m", r"[A-Za-z\x{DF}-\x{FF}]{16,}", None),
        "gazetteer": ("m", r"(?:^|[\x20-])(?:" + "|".join(NO_NAME) + r")(?:[\x20-]|$)", r"^(?:" + "|".join(GIVEN) + r")[\x20-]"),
        "before": ("before", r"(?:the|a|of)\x20$", r"(?:^|[^a-z])(?:" + TITLES + r")[.:,]?\x20$"),
        "after": ("after", r"^[\x20-](?:Inc|Ltd|GmbH|License|Street|University)|^[A-Za-z0-9]", r"^(?:'s\x20|,?\x20(?:born|wrote|said|lives|aged)\x20|\x20?[<(])"),
    },
    "tel": {
        "form": ("m", r"^\(?[0-9]{2,5}\)?\.[0-9]+\.|^\([0-9]+[^0-9)]|^[0-9]+\)", None),
        "gazetteer": ("m", r"^\(?(?:1[0-9]{2}|19[0-9]{2}|20[0-9]{2})[^0-9]", r"^(?:\(?0[0-9]+|0?800|\(?[2-9][0-9]{2}\)?[\x20-][2-9][0-9]{2}-[0-9]{4}$)"),
        "before": ("before", r"(?:isbn|issn|order|invoice|version|page|vol|no|nr|[$#0-9/.-])[.:]?\x20*$",
                   r"(?:tel|phone|telephone|telefon|telefono|call|fax|mobile|cell|whatsapp|sms)[.:]?\x20*$"),
        "after": ("after", r"^[/.-]?[0-9]", r"^\x20*(?:ext|x[0-9])"),
    },
    "ssn": {
        "form": ("m", r"^(?:000|666|9)|-00-|-0000$", None),
        "gazetteer": ("m", r"^(?:078-05-1120|219-09-9999)$", None),
        "before": ("before", r"[0-9/.-]$", r"(?:ssn|social security|social security number|social security no|tax id)[.:#]*\x20*$"),
        "after": ("after", r"^[0-9-]", None),
    },
    "iban": {
        "form": ("m", r"^(?:[A-Z0-9]\x20?){1,14}$|^[A-Z]{2}[0-9]{2}[A-Z\x20]+$", None),
        "gazetteer": ("m", r"^(?:XX|AA|ID|NR|NO0)", r"^(?:" + "|".join(COUNTRIES) + ")"),
        "before": ("before", r"[a-z0-9]$", r"(?:iban|account|konto|compte|cuenta)[.:]?\x20*$"),
        "after": ("after", r"^[A-Za-z0-9]", None),
    },
}
#: What the final classifier reads besides votes: the text, and values with their patterns (the first that fits; else ``other``).
FEATURES: dict[str, tuple[str, dict[str, str]]] = {
    "size": ("m", {"short": r"^.{1,11}$", "middle": r"^.{12,19}$"}),
    "from": ("before", {"edge": r"(?:^|\n)$", "blank": r"\x20$", "mark": r"[.,;:()<>\x22'-]$"}),
    "to": ("after", {"edge": r"^(?:\n|$)", "blank": r"^\x20", "mark": r"^[.,;:()<>\x22'-]"}),
    "word": ("before", {"letters": r"[a-z]\x20$", "closed": r"[.,;:]\x20$"}),
}
BEFORE, AFTER, NEAR, SURE = 40, 12, 60, 0.9
ROUNDS, CLOSE = 16, 1e-10
#: Prior counts of votes (-1, 0, 1) by candidates that are personal data and that are not.
PRIOR = {True: {-1: 0.5, 0: 2.0, 1: 2.0}, False: {-1: 2.0, 0: 2.0, 1: 0.5}}
SPAN = "array<struct<rank:int,start:int,end:int>>"
CANDIDATE = "array<struct<rank:int,start:int,end:int,votes:array<string>,features:array<string>>>"


def places(text: Column, pattern: str, gate: str | None = None) -> Column:
    """All matches in ``text``, in order: start, end, m, and the text around them, as far as the neighbouring matches."""
    def over(found: Column) -> Column:
        def between(pieces: Column) -> Column:
            steps = F.transform(pieces, lambda p, k: F.length(p) + F.when(k > 0, F.length(F.get(found, k - 1))).otherwise(0))

            def spans(step: Column) -> Column:
                return let(running(step, F.lit(0), lambda a, b: a + b), lambda r: F.transform(found, lambda m, k: F.struct(
                    (F.get(r, k) + F.get(step, k)).alias("start"), (F.get(r, k) + F.get(step, k) + F.length(m)).alias("end"), m.alias("m"),
                    F.right(F.get(pieces, k), F.lit(BEFORE)).alias("before"), F.left(F.get(pieces, k + 1), F.lit(AFTER)).alias("after"))))
            return let(steps, spans)
        return let(F.split(text, pattern, -1), between)

    none = F.array().cast("array<struct<start:int,end:int,m:string,before:string,after:string>>")
    return F.when(text.rlike(gate or pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), over)).otherwise(none)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check of payment cards."""
    def worth(k: Column) -> Column:
        d = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        return F.when(k % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, k: a + worth(k)) % 10 == 0


def _stands(kind: str, m: Column) -> Column:
    """Whether a match of a base kind is one of its spans."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(OCTETS)
    low, high = CARD_DIGITS if kind == "card" else PHONE_DIGITS
    return let(F.regexp_replace(m, "[^0-9]", ""), lambda d: F.length(d).between(low, high) & (_luhn(d) if kind == "card" else F.lit(True)))


def _read(c: Column, of: str) -> Column:
    return ascii_lower(c["before"]) if of == "before" else c[of]


def _vote(kind: str, labeler: str, c: Column, base: Column) -> Column:
    if labeler == "beside":
        near = F.exists(base, lambda b: (b["start"] < c["end"] + NEAR) & (c["start"] < b["end"] + NEAR))
        return F.when(near, F.lit("beside:1")).otherwise(F.lit("beside:0"))
    of, against, speaks = VOTES[kind][labeler]
    text, vote = _read(c, of), F.lit(f"{labeler}:0")
    if speaks:
        vote = F.when(text.rlike(speaks), F.lit(f"{labeler}:1")).otherwise(vote)
    return F.when(text.rlike(against), F.lit(f"{labeler}:-1")).otherwise(vote) if against else vote


def _feature(name: str, c: Column) -> Column:
    of, values = FEATURES[name]
    found = F.lit(f"{name}:other")
    for value, pattern in reversed(values.items()):
        found = F.when(_read(c, of).rlike(pattern), F.lit(f"{name}:{value}")).otherwise(found)
    return found


def staged(docs: DataFrame) -> DataFrame:
    """(doc_id, base, weak) of each row: its base spans, and its candidates with their votes and features."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), whole_text().alias("t"))
    t = F.col("t")

    def base(kind: str) -> Column:
        found = F.filter(places(t, LINEAR.get(kind, PATTERNS[kind]), GATES[kind]), lambda s: _stands(kind, s["m"]))
        return F.transform(found, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("rank"), s["start"], s["end"]))
    rows = rows.withColumn("base", F.concat(*map(base, BASE)).cast(SPAN))

    def weak(kind: str) -> Column:
        free = F.filter(places(t, PATTERNS[kind]), lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        return F.transform(free, lambda c: F.struct(
            F.lit(KINDS.index(kind)).alias("rank"), c["start"], c["end"],
            F.array(*[_vote(kind, x, c, F.col("base")) for x in LABELERS]).alias("votes"),
            F.array(*[_feature(x, c) for x in FEATURES]).alias("features")))
    return rows.select("doc_id", "base", F.concat(*map(weak, WEAK)).cast(CANDIDATE).alias("weak"))


class Model:
    """Log odds: ``bias`` by kind, ``weights`` by kind and value of a vote or feature."""

    def __init__(self, bias: dict[int, float], weights: dict[str, float]):
        self.bias, self.weights = bias, weights

    def probability(self, rank: Column, values: Column) -> Column:
        def table(of: dict, key: str) -> Column:
            return F.create_map(*[F.lit(x) for pair in of.items() for x in pair]) if of else F.lit(None).cast(f"map<{key},double>")
        weights = table(self.weights, "string")
        odds = F.aggregate(values, F.coalesce(table(self.bias, "int")[rank], F.lit(0.0)),
                           lambda a, v: a + F.coalesce(weights[F.concat_ws(":", rank.cast("string"), v)], F.lit(0.0)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _log_odds(sums: list, prior) -> tuple[dict[int, float], dict[str, float]]:
    """Bias and weights from ``sums`` (rank, value, yes, no); ``prior`` (group, value) gives the prior counts (yes, no)."""
    totals: dict[tuple[int, str], list[float]] = {}
    for rank, value, yes, no in sums:
        own = totals.setdefault((rank, value.split(":")[0]), [0.0, 0.0])
        own[0], own[1] = own[0] + yes, own[1] + no
    bias, weights = {}, {}
    for (rank, group), (yes, no) in totals.items():
        bias[rank] = math.log((yes + 1) / (no + 1))
        values = prior(group)
        have = {v.split(":")[1]: (a, b) for r, v, a, b in sums if (r, v.split(":")[0]) == (rank, group)}
        all_yes, all_no = sum(a for a, _ in values.values()), sum(b for _, b in values.values())
        for value, (a, b) in values.items():
            x, y = have.get(value, (0.0, 0.0))
            weights[f"{rank}:{group}:{value}"] = math.log((x + a) / (yes + all_yes)) - math.log((y + b) / (no + all_no))
    return bias, weights


def _vote_prior(_: str) -> dict[str, tuple[float, float]]:
    return {str(v): (PRIOR[True][v], PRIOR[False][v]) for v in (-1, 0, 1)}


def _feature_prior(group: str) -> dict[str, tuple[float, float]]:
    return {v: (1.0, 1.0) for v in [*FEATURES[group][1], "other"]}


def _sums(table: DataFrame, values: str, p: Column) -> list:
    """(rank, value, yes, no): at most a row for each kind and value."""
    rows = table.select("rank", "n", p.alias("p"), F.explode(values).alias("value"))
    return [tuple(r) for r in rows.groupBy("rank", "value").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
            .orderBy("rank", "value").collect()]


def fit_votes(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over ``patterns`` (rank, votes, n), starting from the balance of votes."""
    balance = F.aggregate("votes", F.lit(-1.0), lambda a, v: a + F.element_at(F.split(v, ":"), 2).cast("int") * 2.0)
    p, model = F.lit(1.0) / (F.lit(1.0) + F.exp(-balance)), Model({}, {})
    for _ in range(rounds):
        bias, weights = _log_odds(_sums(patterns, "votes", p), _vote_prior)
        moved = max([abs(w - model.weights.get(k, 0.0)) for k, w in weights.items()], default=0.0)
        model = Model(bias, weights)
        p = model.probability(F.col("rank"), F.col("votes"))
        if moved < CLOSE:
            break
    return model


def fit(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """The final classifier, from the candidates of ``rows`` (of ``staged``)."""
    seen = rows.select(F.explode("weak").alias("c")).groupBy("c.rank", "c.votes", "c.features").agg(F.count(F.lit(1)).alias("n"))
    seen = written(seen, "votes")
    patterns = written(seen.groupBy("rank", "votes").agg(F.sum("n").alias("n")), "patterns")
    votes = fit_votes(patterns, rounds)
    soft = votes.probability(F.col("rank"), F.col("votes"))
    _, features = _log_odds(_sums(seen, "features", soft), _feature_prior)
    return Model(votes.bias, votes.weights | features)


def _reported(model: Model, c: Column) -> Column:
    named = F.arrays_overlap(c["votes"], F.array(*[F.lit(f"{x}:1") for x in ("gazetteer", "before", "after")]))
    return named & (F.round(model.probability(c["rank"], F.concat(c["votes"], c["features"])), 9) >= SURE)


def found(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """For each row of ``docs``: doc_id, ``base`` and ``spans`` (rank, start, end; rank is the place in ``KINDS``)."""
    rows = written(staged(docs), "personal")
    model = fit(rows, rounds)
    added = F.transform(F.filter("weak", lambda c: _reported(model, c)), lambda c: F.struct(c["rank"], c["start"], c["end"]))
    return rows.select("doc_id", "base", F.concat("base", added.cast(SPAN)).alias("spans"))


def redacted(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``found`` with the code points that are reported, as one list of runs (start, end) in order."""
    rows = found(docs, rounds)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return rows.select("doc_id", "spans", ordered.alias("runs"))


def _told(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """For each row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans (all, as text) and n_added."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return found(docs, rounds).select(
        "doc_id", *map(count, BASE), F.sha2(_told(F.col("base")).cast("binary"), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"))


def _oracle() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def low(x: str) -> str:
        return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def read(of: str) -> str:
        return low("before") if of == "before" else of

    def matches(kind: str) -> str:
        p = text(PATTERNS[kind])
        return (f"SELECT k, {KINDS.index(kind)} AS rank, i, CAST(list_sum(list_transform(p[:i], lambda x: length(x))) "
                "+ coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, m[i] AS m, "
                f"right(p[i], {BEFORE}) AS before, left(p[i + 1], {AFTER}) AS after FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ("
                f"SELECT k, string_split_regex(t, {p}) AS p, regexp_extract_all(t, {p}) AS m FROM d))")

    def vote(kind: str, labeler: str) -> str:
        if labeler == "beside":
            return (f"CASE WHEN EXISTS (SELECT 1 FROM base b WHERE b.k = w.k AND b.a < w.a + length(w.m) + {NEAR} AND w.a < b.a + length(b.m) + {NEAR}) "
                    "THEN 'beside:1' ELSE 'beside:0' END")
        of, against, speaks = VOTES[kind][labeler]
        when = f"WHEN regexp_matches({read(of)}, {text(against)}) THEN '{labeler}:-1' " if against else ""
        when += f"WHEN regexp_matches({read(of)}, {text(speaks)}) THEN '{labeler}:1' " if speaks else ""
        return f"CASE {when}ELSE '{labeler}:0' END" if when else f"'{labeler}:0'"

    def feature(name: str) -> str:
        of, values = FEATURES[name]
        return "CASE " + " ".join(f"WHEN regexp_matches({read(of)}, {text(p)}) THEN '{name}:{v}'" for v, p in values.items()) + f" ELSE '{name}:other' END"

    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(reverse({digits})[i + 1] AS INT) "
            f"ELSE CAST(reverse({digits})[i + 1] AS INT) * 2 - CASE WHEN CAST(reverse({digits})[i + 1] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0")
    stands = (f"rank = 0 OR rank = 1 AND regexp_matches(m, {text(OCTETS)}) OR rank = 2 AND length({digits}) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND {luhn} "
              f"OR rank = 3 AND length({digits}) BETWEEN {PHONE_DIGITS[0]} AND {PHONE_DIGITS[1]}")
    of_kind = "\nUNION ALL ".join(
        f"SELECT w.k, w.rank, w.a, w.m, [{', '.join(vote(k, x) for x in LABELERS)}] AS votes, [{', '.join(map(feature, FEATURES))}] AS features FROM free w WHERE rank = {KINDS.index(k)}"
        for k in WEAK)
    votes_prior = ", ".join(f"('{g}', '{v}', {PRIOR[True][v]}, {PRIOR[False][v]})" for g in LABELERS for v in (-1, 0, 1))
    features_prior = ", ".join(f"('{g}', '{v}', 1.0, 1.0)" for g in FEATURES for v in _feature_prior(g))

    def odds(name: str, sums: str, prior: str) -> str:
        """Weights from (rank, value, yes, no)."""
        return f"""
{name} AS MATERIALIZED (SELECT t.rank, p.g || ':' || p.v AS value, ln((coalesce(s.yes, 0) + p.y) / (t.yes + p.ay)) - ln((coalesce(s.no, 0) + p.n) / (t.no + p.an)) AS w,
  ln((t.yes + 1) / (t.no + 1)) AS bias FROM (SELECT rank, split_part(value, ':', 1) AS g, sum(yes) AS yes, sum(no) AS no FROM {sums} GROUP BY ALL) t
  JOIN (SELECT *, sum(y) OVER (PARTITION BY g) AS ay, sum(n) OVER (PARTITION BY g) AS an FROM (VALUES {prior}) x(g, v, y, n)) p USING (g)
  LEFT JOIN {sums} s ON s.rank = t.rank AND s.value = p.g || ':' || p.v)"""
    parts = [rf"""
d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED (SELECT * FROM ({chr(10).join([" UNION ALL ".join(map(matches, BASE))])}) WHERE {stands}),
free AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(map(matches, WEAK))}) w
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.k = w.k AND b.a < w.a + length(w.m) AND w.a < b.a + length(b.m))),
weak AS MATERIALIZED ({of_kind}),
e AS MATERIALIZED (SELECT *, row_number() OVER () AS id, list_sum(list_transform(votes, lambda v: CAST(split_part(v, ':', 2) AS DOUBLE))) * 2 - 1 AS start
  FROM (SELECT rank, votes, count(*) AS n FROM weak GROUP BY ALL)),
x AS MATERIALIZED (SELECT id, rank, n, unnest(votes) AS value FROM e),
q0 AS MATERIALIZED (SELECT id, 1 / (1 + exp(-start)) AS q FROM e)"""]
    for r in range(ROUNDS):
        parts.append(f"""
s{r} AS MATERIALIZED (SELECT rank, value, sum(n * q) AS yes, sum(n * (1 - q)) AS no FROM x JOIN q{r} USING (id) GROUP BY ALL)""")
        parts.append(odds(f"w{r}", f"s{r}", votes_prior))
        parts.append(f"""
q{r + 1} AS MATERIALIZED (SELECT id, 1 / (1 + exp(-(any_value(bias) + sum(w)))) AS q FROM x JOIN w{r} USING (rank, value) GROUP BY id)""")
    parts.append(f"""
soft AS MATERIALIZED (SELECT weak.*, row_number() OVER () AS c, q FROM weak JOIN e USING (rank, votes) JOIN q{ROUNDS} USING (id)),
sf AS MATERIALIZED (SELECT rank, value, sum(q) AS yes, sum(1 - q) AS no FROM (SELECT rank, q, unnest(features) AS value FROM soft) GROUP BY ALL)""")
    parts.append(odds("wf", "sf", features_prior))
    last = f"w{ROUNDS - 1}"
    parts.append(f"""
p AS (SELECT c, 1 / (1 + exp(-((SELECT any_value(bias) FROM {last} b WHERE b.rank = y.rank) + sum(w)))) AS p
  FROM (SELECT c, rank, unnest(votes || features) AS value FROM soft) y JOIN (SELECT rank, value, w FROM {last} UNION ALL SELECT rank, value, w FROM wf) USING (rank, value) GROUP BY c, y.rank),
every AS (SELECT k, rank, a, a + length(m) AS z FROM base UNION ALL SELECT k, rank, a, a + length(m) FROM soft JOIN p USING (c)
  WHERE round(p, 9) >= {SURE} AND list_has_any(votes, ['gazetteer:1', 'before:1', 'after:1'])),
told AS (SELECT k, rank, a, [{', '.join(map(text, KINDS))}][rank + 1] || ':' || a || ':' || z AS s FROM every),
g AS (SELECT k, {', '.join(f"count(*) FILTER (rank = {i}) AS n_{kind}" for i, kind in enumerate(BASE))}, count(*) FILTER (rank >= {len(BASE)}) AS n_added,
  string_agg(s, ',' ORDER BY rank, a) FILTER (rank < {len(BASE)}) AS own, string_agg(s, ',' ORDER BY rank, a) AS spans FROM told GROUP BY k)
SELECT doc_id, {', '.join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in BASE)}, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_added, 0) AS n_added FROM d LEFT JOIN g USING (k)""")
    return "WITH" + ",".join(parts[:-1]) + "," + parts[-1]


ORACLE_SQL = _oracle()
