"""API error classification as a column expression (no Python per row).

Input per row: HTTP ``status_code`` (NULL for transport failures such as a
timeout or a refused connection) and the response ``body`` text. Reasons are
gathered from ``error.errors[*].reason`` and ``error.reason``; the first
matching rule wins:

1. reason ``commentsDisabled``                      -> COMMENTS_DISABLED
2. a rate-limit reason, or status 429              -> RATE_LIMITED
3. a quota reason                                  -> QUOTA_EXCEEDED
4. status 401 or 403                               -> AUTHENTICATION
5. status 404                                      -> NOT_FOUND
6. status 400                                      -> INVALID_REQUEST
7. status 500, 502, 503 or 504                     -> TRANSIENT_SERVER
8. no status at all (transport failure)            -> TRANSIENT_NETWORK
9. anything else                                   -> UNKNOWN

``retryable`` is true for RATE_LIMITED, TRANSIENT_SERVER and
TRANSIENT_NETWORK. The message is the category in brackets and the fixed text
for an HTTP error (status and body) or a transport failure (its cause).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoledger import schemas as S

ERROR_BODY_SCHEMA = "struct<error: struct<reason: string, errors: array<struct<reason: string>>>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parsed_error(body) -> Column:
    """The ``error`` object of a body; NULL unless the body is a JSON object
    (plain-text bodies never reach the JSON parser)."""
    b = _c(body)
    return F.when(F.ltrim(b).startswith("{"), F.from_json(b, ERROR_BODY_SCHEMA)["error"])


def reasons_of(err: Column) -> Column:
    """Distinct non-empty reasons of a parsed ``error`` object."""
    listed = F.coalesce(F.transform(err["errors"], lambda e: e["reason"]), F.array().cast("array<string>"))
    own = F.array(err["reason"])
    return F.array_distinct(F.filter(F.concat(listed, own), lambda r: r.isNotNull() & (r != "")))


def error_reasons(body) -> Column:
    """Distinct non-empty reasons of an error body (empty array if none)."""
    return reasons_of(parsed_error(body))


def _lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _category(reasons: Column, code: Column) -> Column:
    """The rules, in order."""
    return (F.when(F.array_contains(reasons, "commentsDisabled"), "COMMENTS_DISABLED")
            .when(F.arrays_overlap(reasons, _lits(S.RATE_LIMIT_REASONS)) | (code == 429), "RATE_LIMITED")
            .when(F.arrays_overlap(reasons, _lits(S.QUOTA_REASONS)), "QUOTA_EXCEEDED")
            .when(code.isin(401, 403), "AUTHENTICATION")
            .when(code == 404, "NOT_FOUND")
            .when(code == 400, "INVALID_REQUEST")
            .when(code.isin(*[c for c in S.TRANSIENT_STATUS_CODES if c != 429]), "TRANSIENT_SERVER")
            .when(code.isNull(), "TRANSIENT_NETWORK")
            .otherwise("UNKNOWN"))


def _message(category: Column, code: Column, body: Column) -> Column:
    text = F.coalesce(body, F.lit(""))
    return F.concat(F.lit("["), category, F.lit("] "), F.when(code.isNull(), F.concat(F.lit(S.MSG_NETWORK_ERROR), text)).otherwise(
        F.concat(F.lit(S.MSG_HTTP_ERROR), code.cast("string"), F.lit(": "), text)))


def error_category(status_code, body) -> Column:
    return _category(error_reasons(body), _c(status_code))


def classify_error(status_code, body) -> Column:
    """struct<category, retryable, message> for one failed request."""
    cat = error_category(status_code, body)
    return F.struct(cat.alias("category"), cat.isin(*S.RETRYABLE_CATEGORIES).alias("retryable"),
                    _message(cat, _c(status_code), _c(body)).alias("message"))


def with_error_class(df, status_code: str, body: str, prefix: str = ""):
    """``df`` plus ``category``, ``retryable`` and ``message`` columns.

    The body is parsed once, in a step of its own: several rules refer to
    its reasons."""
    code = F.col(status_code)
    staged = df.withColumn("__err", parsed_error(body)).withColumn("__reasons", reasons_of(F.col("__err"))).drop("__err")
    staged = staged.withColumn(prefix + "category", _category(F.col("__reasons"), code)).drop("__reasons")
    c = F.col(prefix + "category")
    return (staged.withColumn(prefix + "retryable", c.isin(*S.RETRYABLE_CATEGORIES))
            .withColumn(prefix + "message", _message(c, code, F.col(body))))


def step_outcome_from_error(category, message) -> tuple[Column, Column]:
    """(status, error) of a per-video step: no error or COMMENTS_DISABLED is
    SUCCESS; any other API error is FAILED with its message."""
    cat = _c(category)
    ok = cat.isNull() | (cat == "COMMENTS_DISABLED")
    return (F.when(ok, S.ST_SUCCESS).otherwise(S.ST_FAILED),
            F.when(~ok, _c(message)))
