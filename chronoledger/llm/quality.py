"""Line-first quality rules.

Each line of a document is judged alone (closing punctuation, navigation
bars, boilerplate phrases, symbol noise, shouting); failing lines go, and a
document that loses too much of its text with them goes whole. Everything is
computed inside the row by built-in functions, so the work is one scan
without any shuffle, however unequal sources or documents are.

Defined cases: a NULL text counts as empty; an empty text has no words and
fails; repeated rows are judged alike, each for itself; the input's other
columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import WORD, let, whole_text

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
CLOSED = r"[.!?:;,\x22'\x29…”’»][\x20\x09-\x0D]*$"
SEPARATOR = r"[|»›•·>]"
SHOUT = r"[!?][!?]+"
BOILERPLATE = (r"cookie (?:policy|settings|notice)|enable javascript|javascript (?:is )?(?:disabled|required)"
               r"|lorem ipsum|terms of (?:use|service)|privacy policy|click here|read more|sign (?:in|up) (?:to|for|now)"
               r"|log ?in to (?:your|continue)|subscribe to (?:our|the)|share (?:this|on)|back to top|skip to (?:main|content)"
               r"|page not found|add to cart|load more|related (?:posts|articles)|all comments")

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A line fails at this many separators, symbols or shouts in a hundred words.
NAV_PERCENT, SYMBOL_PERCENT, SHOUT_PERCENT = 25, 50, 25
#: A line without closing punctuation needs this many words, a boilerplate line has fewer than that many.
OPEN_LINE_WORDS, BOILERPLATE_WORDS = 4, 30
#: A document keeps at least this share of the characters of its words.
MIN_LEFT_PERCENT = 50


def _line_fails(line: Column) -> Column:
    """The line rules. A line without words never fails: it carries no text."""
    words = F.regexp_count(line, F.lit(WORD))

    def rules(n: Column) -> Column:
        def share(pattern: str, percent: int, least: int) -> Column:
            return let(F.regexp_count(line, F.lit(pattern)), lambda k: (k >= least) & (k * 100 >= n * percent))
        return (n > 0) & (
            share(SEPARATOR, NAV_PERCENT, 1)
            | share(SYMBOLS, SYMBOL_PERCENT, 3)
            | share(SHOUT, SHOUT_PERCENT, 3)
            | ((n < OPEN_LINE_WORDS) & ~line.rlike(CLOSED))
            | ((n < BOILERPLATE_WORDS) & F.lower(line).rlike(BOILERPLATE)))
    return let(words, rules)


def _chars(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda n, w: n + F.length(w))


def _repeat_words(words: Column, size: int) -> Column:
    """How many words stand in a window of ``size`` words that occurs twice or more.

    Hashes of the windows only tell that a text has no repeated window; the
    other texts are settled by sorting the windows themselves.
    """
    return let(words, lambda w: _covered(w, F.size(w), size))


def _covered(words: Column, n: Column, size: int) -> Column:
    starts = F.sequence(F.lit(0), n - size)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    differ = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    windows = F.array_sort(F.transform(starts, lambda i: F.struct(
        F.array_join(F.slice(words, i + 1, size), " ").alias("w"), i.alias("i"))))

    def covered(s: Column) -> Column:
        at = F.array_sort(F.transform(F.filter(F.transform(s, lambda x, k: F.when(
            F.coalesce(F.get(s, k - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["w"] == x["w"], F.lit(False)), x["i"])), lambda i: i.isNotNull()), lambda i: i))
        return let(at, lambda p: F.aggregate(F.transform(p, lambda i, k: F.least(
            F.lit(size), F.coalesce(F.get(p, k + 1) - i, F.lit(size)))), F.lit(0).cast("bigint"), lambda a, b: a + b))
    return (F.when((n < size) | differ, F.lit(0).cast("bigint")).otherwise(let(windows, covered)))


def assess(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Judge every row of ``docs`` (needs ``text``); ``keep`` names the input
    columns to carry along (default ``doc_id``).

    Adds ``cleaned`` (the text without failing lines), the counts, the
    verdict of the base rules and ``kept``.
    """
    keep = ["doc_id"] if keep is None else keep
    text = whole_text()
    rows = docs.select(*[F.col(c).alias(f"in_{i}") for i, c in enumerate(keep)], text.alias("t"))
    rows = rows.withColumns({"ws": F.regexp_extract_all("t", F.lit(WORD), F.lit(0)), "ls": F.split("t", "\n", -1)})
    rows = rows.withColumns({
        "n": F.size("ws"),
        "full": F.filter("ls", lambda x: x.rlike(WORD)),
        "left": F.filter("ls", lambda x: ~_line_fails(x)),
    })
    rows = rows.withColumns({
        "word_chars": _chars(F.col("ws")),
        "n_symbols": (F.length("t") - F.length(F.regexp_replace("t", f"{SYMBOLS}+", ""))).cast("bigint"),
        "n_dup_lines": (F.size("full") - F.size(F.array_distinct("full"))).cast("bigint"),
        "n_repeat_words": _repeat_words(F.col("ws"), 5),
        "cleaned": F.array_join("left", "\n"),
    })
    rows = rows.withColumns({
        "base_failed": (F.col("n") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n") * MAX_REPEAT_PERCENT),
        "left_chars": F.length(F.regexp_replace("cleaned", SPACE, "")).cast("bigint"),
        "n_failed_lines": (F.size("ls") - F.size("left")).cast("bigint"),
    })
    kept = ~F.col("base_failed") & (F.col("left_chars") * 100 >= F.col("word_chars") * MIN_LEFT_PERCENT)
    return rows.select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(keep)], F.col("n").cast("bigint").alias("n_words"),
        "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"),
        "n_failed_lines", "left_chars", F.col("cleaned").alias("cleaned"))


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned texts, in the columns of ``docs``."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    safe = {c: f"col_{i}" for i, c in enumerate(others)}
    good = assess(docs.select(*[F.col(c).alias(n) for c, n in safe.items()], "text"), list(safe.values())).where("kept")
    new = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("bigint")}
    return good.select(*[new.get(c, F.col(safe.get(c, "cleaned"))).alias(c) for c in docs.columns])


def _re2(pattern: str) -> str:
    """RE2 writes code points as \\x{...}."""
    return re.sub(r"\\u(\w{4})", r"\\x{\1}", pattern).replace("'", "''")


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT k, unnest(range(len(ws) - 4)) AS i, ws FROM w WHERE len(ws) >= 5),
s AS (SELECT k, i, count(*) OVER (PARTITION BY k, ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4], ws[i + 5]) AS c FROM g),
r AS (SELECT k, least(5, coalesce(lead(i) OVER (PARTITION BY k ORDER BY i) - i, 5)) AS n FROM s WHERE c > 1),
rep AS (SELECT k, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY k),
l AS (SELECT k, unnest(ls) AS line FROM w),
m AS (SELECT k, line, len(regexp_extract_all(line, '{WORD}')) AS n,
  len(regexp_extract_all(line, '{_re2(SEPARATOR)}')) AS seps, len(regexp_extract_all(line, '{SYMBOLS}')) AS syms,
  len(regexp_extract_all(line, '{SHOUT}')) AS shouts, regexp_matches(line, '{_re2(CLOSED)}') AS closed,
  regexp_matches(lower(line), '{BOILERPLATE}') AS boiler FROM l),
f AS (SELECT k, line, n, n > 0 AND ((seps >= 1 AND seps * 100 >= n * {NAV_PERCENT})
  OR (syms >= 3 AND syms * 100 >= n * {SYMBOL_PERCENT}) OR (shouts >= 3 AND shouts * 100 >= n * {SHOUT_PERCENT})
  OR (n < {OPEN_LINE_WORDS} AND NOT closed) OR (n < {BOILERPLATE_WORDS} AND boiler)) AS failed FROM m),
a AS (SELECT k, CAST(count(*) FILTER (failed) AS BIGINT) AS n_failed_lines,
  CAST(count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS BIGINT) AS n_dup_lines,
  CAST(sum(length(regexp_replace(line, '{SPACE}', '', 'g'))) AS BIGINT) AS word_chars,
  CAST(coalesce(sum(length(regexp_replace(line, '{SPACE}', '', 'g'))) FILTER (NOT failed), 0) AS BIGINT) AS left_chars
  FROM f GROUP BY k),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, a.word_chars,
  CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols, a.n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, a.n_failed_lines, a.left_chars
  FROM w JOIN a USING (k) LEFT JOIN rep USING (k))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
  AND left_chars * 100 >= word_chars * {MIN_LEFT_PERCENT} AS kept FROM b
"""
