"""License scan by ordered signature rules.

A text is read as its words, each with a space on either side, so that a
signature never matches inside a word. A text without any of a few stems is
done; in others, each rule whose keyword occurs is run, and all its places
are found. Detections are resolved by priority and containment: one that
lies within another of higher priority is suppressed, and so is one within
another of equal priority (of two equal places, the later rule's). A sweep in
order of the starts, with the furthest end so far for each priority, decides
this without comparing pairs.

Everything is computed inside the row by built-in functions, without a
shuffle. Three base phrases are always counted and their labels always stay.

Defined cases: a NULL text is empty; a text without words has no labels and
score 0; repeated rows are each scanned; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import ascii_lower, let, running, whole_text
from chronoledger.llm.license_rules import pattern, rules

#: Phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_CONFIDENCE = 0.5
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = 5
#: One of these stands in each text that some rule can match.
STEMS = ["licen", "copyright", "rights", "cc0", " cc ", "gpl", "spdx", "permission", "permitted", "redistribut", "public", "commons", "warrant",
         "proprietary", "prohibited", "reproduced", "consent", "bsd", "wtfpl", "openrail", "unencumbered", "misrepresented", "machine  executable",
         "advertising", "nor  the  names", "any  later  version", "invariant", " use  only ", "no  attribution", " org ", " net ", " europa ", "huggingface"]


def spaced(words: str) -> str:
    return "".join(f" {w} " for w in words.split())


def _normal(text: Column) -> Column:
    """The words with a space on either side of each."""
    words = F.trim(F.regexp_replace(ascii_lower(text), BREAKS, " "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" ")))


def _words(t: Column) -> Column:
    """How many words a piece of normal text has."""
    return ((F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit("")))) / 2).cast("int")


def _places(text: Column, rule: Column) -> Column:
    """All places of a rule: its number, label, priority, confidence, first word and the word after its last."""
    def over(found: Column) -> Column:
        def among(pieces: Column) -> Column:
            steps = F.transform(pieces, lambda p, k: _words(p) + F.when(k > 0, _words(F.get(found, k - 1))).otherwise(0))
            return let(steps, lambda s: let(running(s, F.lit(0), lambda a, b: a + b), lambda before: F.transform(
                found, lambda f, k: F.struct(
                    (F.get(before, k) + F.get(s, k)).alias("start"),
                    (-(F.get(before, k) + F.get(s, k) + _words(f))).alias("minus_end"),
                    (-rule["priority"]).alias("minus_priority"), rule["rule"].alias("rule"), rule["label"].alias("label"),
                    rule["confidence"].alias("confidence")))))
        return let(F.split(text, rule["pattern"], -1), among)
    return let(F.regexp_extract_all(text, rule["pattern"], F.lit(0)), over)


def _resolved(found: Column) -> Column:
    """The detections that stay: sorted, swept by the furthest end of each priority and above."""
    def sweep(d: Column) -> Column:
        ends = F.transform(d, lambda x: F.transform(F.sequence(F.lit(0), F.lit(PRIORITIES - 1)), lambda p: F.when(
            -x["minus_priority"] >= p, -x["minus_end"]).otherwise(-1)))
        none = F.array(*[F.lit(-1)] * PRIORITIES)
        furthest = running(ends, none, lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)))
        return let(furthest, lambda f: F.filter(d, lambda x, k: F.get(F.get(f, k), -x["minus_priority"]) < -x["minus_end"]))
    return let(F.array_sort(found), sweep)


def scan(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, and ``detections`` (start, end,
    label, priority, confidence; places count words)."""
    table = F.array(*[F.struct(
        F.lit(k).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"),
        F.lit(r.keyword).alias("keyword"), F.lit(pattern(r.words)).alias("pattern")) for k, r in enumerate(rules())])
    t = F.col("t")
    rows = docs.select(F.col("doc_id").alias("doc_id"), _normal(whole_text()).alias("t"))
    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | t.contains(stem)
    empty = F.array().cast("array<struct<start:int,minus_end:int,minus_priority:int,rule:int,label:string,confidence:double>>")
    hits = F.flatten(F.transform(F.filter(table, lambda r: F.contains(t, r["keyword"])), lambda r: _places(t, r)))
    rows = rows.withColumn("found", F.when(gate, _resolved(hits)).otherwise(empty))
    here = {label: F.when(t.contains(spaced(p)), label) for p, label in BASE.items()}
    first = [F.when(t.contains(spaced(p)), _words(F.substring_index(t, spaced(p), 1))) for p in BASE]
    last = [F.when(t.contains(spaced(p)), _words(t) - _words(F.substring_index(t, spaced(p), -1)) - len(p.split())) for p in BASE]
    count = sum(((F.length(t) - F.length(F.replace(t, F.lit(spaced(p)), F.lit("")))) / len(spaced(p)) for p in BASE), F.lit(0))
    base = F.array_compact(F.array(*here.values()))
    return rows.select(
        "doc_id", _words(t).cast("bigint").alias("n_words"), count.cast("bigint").alias("n_base"),
        F.least(*first).cast("bigint").alias("first_word"), F.greatest(*last).cast("bigint").alias("last_word"),
        base.alias("base"), "found",
    ).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("found", lambda d: d["label"])))), ",").alias("labels"),
        F.greatest(F.when(F.col("n_base") > 0, BASE_CONFIDENCE).otherwise(0.0),
                   F.coalesce(F.array_max(F.transform("found", lambda d: d["confidence"])), F.lit(0.0))).alias("score"),
        F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"),
                                                (-d["minus_priority"]).alias("priority"), d["confidence"].alias("confidence"))).alias("detections"))


def _oracle() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    places = "\nUNION ALL ".join(
        f"SELECT k, {n} AS rule, {text(r.label)} AS label, {r.priority} AS priority, {r.confidence} AS confidence, "
        f"string_split_regex(t, {text(pattern(r.words))}) AS p, regexp_extract_all(t, {text(pattern(r.words))}) AS m "
        f"FROM d WHERE contains(t, {text(r.keyword)})" for n, r in enumerate(rules()))

    def words(x: str) -> str:
        return f"((length({x}) - length(replace({x}, ' ', ''))) // 2)"
    base = "\nUNION ALL ".join(
        f"SELECT k, {text(label)} AS label, len(string_split(t, {text(spaced(p))})) - 1 AS n, "
        f"{words(f'string_split(t, {text(spaced(p))})[1]')} AS first_word, "
        f"{words('t')} - {words(f'string_split(t, {text(spaced(p))})[-1]')} - {len(p.split())} AS last_word "
        f"FROM d WHERE contains(t, {text(spaced(p))})" for p, label in BASE.items())
    return rf"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id,
  trim(regexp_replace(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{BREAKS}', ' ', 'g')) AS j FROM documents),
d AS MATERIALIZED (SELECT k, doc_id, CASE WHEN j = '' THEN '' ELSE ' ' || replace(j, ' ', '  ') || ' ' END AS t FROM w),
b AS ({base}),
bs AS (SELECT k, CAST(sum(n) AS BIGINT) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word,
  list(label) AS base FROM b GROUP BY k),
r AS ({places}),
u AS (SELECT k, rule, label, priority, confidence, p, m, unnest(range(1, len(m) + 1)) AS i FROM r),
s AS (SELECT k, rule, label, priority, confidence,
  CAST(list_sum(list_transform(p[:i], lambda x: {words('x')})) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: {words('x')})), 0) AS BIGINT) AS a,
  {words('m[i]')} AS n FROM u),
kept AS (SELECT * FROM s x WHERE NOT EXISTS (SELECT 1 FROM s y WHERE y.k = x.k AND y.a <= x.a AND y.a + y.n >= x.a + x.n
  AND (y.priority > x.priority OR y.priority = x.priority AND (y.n > x.n OR y.n = x.n AND y.rule < x.rule)))),
ks AS (SELECT k, list(label) AS own, max(confidence) AS best, count(*) AS n FROM kept GROUP BY k)
SELECT doc_id, CAST({words('t')} AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') AS labels,
  greatest(CASE WHEN n_base > 0 THEN {BASE_CONFIDENCE} ELSE 0.0 END, coalesce(best, 0.0))::DOUBLE AS score,
  CAST(coalesce(ks.n, 0) AS BIGINT) AS n_detections
FROM d LEFT JOIN bs USING (k) LEFT JOIN ks USING (k)"""


ORACLE_SQL = _oracle()
