"""Scalar column expressions (all JVM-side; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utc_to_local(ts, zone: str) -> Column:
    """UTC instant -> wall-clock time in ``zone``, as ``timestamp_ntz``."""
    return F.from_utc_timestamp(_c(ts), zone).cast("timestamp_ntz")


def epoch_seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (NULL when ``end`` is NULL)."""
    return F.when(_c(end).isNotNull(), F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start)))


def add_hours(ts, hours) -> Column:
    """``ts`` plus a column-valued number of hours (type of ``ts`` kept)."""
    return _c(ts) + F.make_dt_interval(F.lit(0), _c(hours).cast("int"))


def strip_handle(handle) -> Column:
    """Remove one leading ``@`` from a channel handle."""
    return F.regexp_replace(_c(handle), r"^@", "")


def counter(value, default_zero: bool) -> Column:
    """API counter (string or number) -> bigint; a missing counter is 0 when
    ``default_zero`` else NULL. Unparseable text becomes NULL (``try_cast``)."""
    v = _c(value).cast("string").try_cast("bigint")
    return F.coalesce(v, F.lit(0).cast("bigint")) if default_zero else v
