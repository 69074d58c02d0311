"""Secret scan that links the parts of a credential.

Base spans (assignments, access keys, hex runs) are always reported. Weak
candidates are parts that mean little alone: long mixed runs (``key``), names
of accounts (``id``) and addresses (``endpoint``). They are reported only
when complementary parts stand within ``REACH`` code points, from the end of
one to the start of the other, in the same scope, a scope being a stretch of
text without an empty line:

* a ``key`` beside an identifier (an access key or an ``id``);
* an ``id`` beside a secret (an assignment, a hex run or a ``key``);
* an ``endpoint`` beside both an identifier and a secret.

Texts are read once, for base spans; those that hold a secret are kept with
them, and their parts, found scope by scope, are a small table of their own.
Linking is an interval join over it: a part is dealt to each stretch of
``REACH`` code points that it covers, a candidate to all that it can reach,
and semi-joins find what co-occurs, so a text with many parts is no single
task's and pairs are never made. Only built-in functions are used.

Defined cases: a NULL text is empty; equal rows are each reported; spans are
in code points, end exclusive; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoledger.llm.common import let, running, whole_text, written

REACH = 120
KINDS = ["assign", "access", "hex", "key", "id", "endpoint"]


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: The base kinds. The first's value must have six characters.
NAMES = "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either("api") + "_?" + _either("key")
PATTERNS = {
    "assign": rf"(?:{NAMES})[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "key": "[A-Za-z0-9+/_-]{32,}",
    "id": r"(?:[Aa]ccess_?[Kk]ey_?[Ii][Dd]|[Cc]lient_?[Ii][Dd]|[Uu]ser(?:name)?|[Ll]ogin|[Aa]ccount)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9@._-]{3,}",
    "endpoint": r"https?://[^\x00-\x20\x22'<>]{4,}|[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?::[0-9]+)?",
}
LEAST_VALUE = 6
IDENTIFIERS, SECRETS = ["access", "id"], ["assign", "hex", "key"]
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _all(text: Column, kind: str) -> Column:
    """All spans of a kind in ``text``, in order."""
    pattern = PATTERNS[kind]

    def over(found: Column) -> Column:
        before = F.transform(F.split(text, pattern, -1), lambda p, k: F.length(p) + F.when(k > 0, F.length(F.get(found, k - 1))).otherwise(0))

        def spans(steps: Column) -> Column:
            return let(running(steps, F.lit(0), lambda a, b: a + b), lambda r: F.transform(found, lambda f, k: F.struct(
                (F.get(r, k) + F.get(steps, k)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                (F.get(r, k) + F.get(steps, k) + F.length(f)).alias("end"), F.lit(kind).alias("kind"))))
        whole = let(before, spans)
        if kind == "assign":
            values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
            return let(values, lambda v: F.filter(whole, lambda _, k: F.length(F.get(v, k)) >= LEAST_VALUE))
        if kind == "key":
            return F.filter(whole, lambda s, k: F.get(found, k).rlike("[0-9]") & F.get(found, k).rlike("[A-Za-z]"))
        return whole
    # One search tells that most texts have none.
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), over)).otherwise(F.array().cast(SPANS))


def staged(docs: DataFrame) -> DataFrame:
    """(row, doc_id, own, t) of each row of ``docs``: its base spans, and its text if it holds a secret."""
    text = whole_text()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc_id"), text.alias("t"), F.concat(*[_all(text, k) for k in KINDS[:3]]).alias("own"))
    held = F.exists("own", lambda s: s["kind"] != "access") | F.col("t").rlike(PATTERNS["key"])
    return written(rows.select("row", "doc_id", "own", F.when(held, F.col("t")).alias("t")), "secrets")


def _parts(rows: DataFrame) -> DataFrame:
    """(row, scope, kind, start, end) of all parts in the texts of ``rows``."""
    rows = rows.where("t IS NOT NULL").select("row", F.split("t", "\n\n", -1).alias("scopes"))
    rows = rows.select("row", "scopes", running(F.transform("scopes", lambda s: F.length(s) + 2), F.lit(0), lambda a, b: a + b).alias("at"))
    rows = rows.select("row", F.posexplode(F.arrays_zip("scopes", "at"))).select(
        "row", F.col("pos").alias("scope"), F.col("col.scopes").alias("t"), F.col("col.at").alias("at"))
    spans = F.flatten(F.array(*[_all(F.col("t"), k) for k in KINDS]))
    return (rows.select("row", "scope", "at", F.explode(spans).alias("s"))
            .select("row", "scope", "s.kind", (F.col("at") + F.col("s.start")).alias("start"), (F.col("at") + F.col("s.end")).alias("end")))


def _beside(candidates: DataFrame, parts: DataFrame, kinds: list[str], reach: int) -> DataFrame:
    """Candidates with a part of ``kinds`` at most ``reach`` from their end or before their start."""
    def stretches(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach)))
    near = candidates.withColumn("stretch", stretches(F.col("start") - reach, F.col("end") + reach)).alias("c")
    there = parts.where(F.col("kind").isin(kinds)).select("row", "scope", "start", "end", stretches(F.col("start"), F.col("end")).alias("stretch")).alias("p")
    on = [F.col(f"c.{c}") == F.col(f"p.{c}") for c in ("row", "scope", "stretch")]
    gap = F.greatest("p.start", "c.start") - F.least("p.end", "c.end")
    return near.join(there, [*on, gap <= reach], "left_semi").drop("stretch").distinct()


def linked(rows: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, scope, kind, start, end) of the weak candidates in ``rows`` (of ``staged``) whose complementary parts co-occur."""
    parts = written(_parts(rows), "parts")
    of = {k: parts.where(F.col("kind") == k) for k in ("key", "id", "endpoint")}
    return (_beside(of["key"], parts, IDENTIFIERS, reach)
            .unionByName(_beside(of["id"], parts, SECRETS, reach))
            .unionByName(_beside(_beside(of["endpoint"], parts, IDENTIFIERS, reach), parts, SECRETS, reach)))


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """For each row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans (all, as text) and n_linked."""
    base = staged(docs)
    added = linked(base, reach).groupBy("row").agg(F.collect_list(F.struct(
        "start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("rank"), "end", "kind")).alias("added"))
    rows = base.select("row", "doc_id", "own").join(added, "row", "left")
    more = F.coalesce(F.col("added"), F.array().cast(SPANS))
    return rows.select(
        "doc_id", *[F.size(F.filter("own", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_told(F.col("own")).cast("binary"), 256).alias("base_sha256"),
        _told(F.concat("own", more)).alias("spans"), F.size(more).cast("bigint").alias("n_linked"))


def _oracle() -> str:
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def spans(kind: str, table: str) -> str:
        p = text(PATTERNS[kind])
        drop = {"assign": f"length(v[i]) >= {LEAST_VALUE}", "key": "regexp_matches(m[i], '[0-9]') AND regexp_matches(m[i], '[A-Za-z]')"}.get(kind, "true")
        value = f", regexp_extract_all(t, {p}, 1) AS v" if kind == "assign" else ""
        return (f"SELECT k, scope, {KINDS.index(kind)} AS rank, '{kind}' AS kind, "
                "CAST(base + list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, "
                f"length(m[i]) AS n FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT k, scope, base, "
                f"string_split_regex(t, {p}) AS p, regexp_extract_all(t, {p}) AS m{value} FROM {table})) WHERE {drop}")
    every = "\nUNION ALL ".join(spans(k, "s") for k in KINDS)

    def beside(kinds: list[str]) -> str:
        return (f"EXISTS (SELECT 1 FROM parts y WHERE y.k = x.k AND y.scope = x.scope AND y.kind IN ({', '.join(map(text, kinds))}) "
                f"AND greatest(y.a, x.a) - least(y.a + y.n, x.a + x.n) <= {REACH})")
    told = "string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, rank)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
q AS (SELECT k, string_split(t, chr(10) || chr(10)) AS ss FROM d),
u AS (SELECT k, ss, unnest(range(1, len(ss) + 1)) AS i FROM q),
s AS MATERIALIZED (SELECT k, i AS scope, ss[i] AS t, coalesce(list_sum(list_transform(ss[:i - 1], lambda x: length(x) + 2)), 0) AS base FROM u),
parts AS MATERIALIZED ({every}),
more AS (SELECT * FROM parts x WHERE rank < 3 OR kind = 'key' AND {beside(IDENTIFIERS)} OR kind = 'id' AND {beside(SECRETS)}
  OR kind = 'endpoint' AND {beside(IDENTIFIERS)} AND {beside(SECRETS)}),
g AS (SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, {told} FILTER (rank < 3) AS own, {told} AS spans, count(*) FILTER (rank > 2) AS n_linked FROM more GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked FROM d LEFT JOIN g USING (k)"""


ORACLE_SQL = _oracle()
