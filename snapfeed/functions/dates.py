"""Date parsing and display (DATE-1 .. DATE-3).

``as_of`` is always an explicit column or literal (typically ``max(ts)`` of the input as a
scalar subquery), never the wall clock, so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried, in order, after the ISO-8601 default (DATE-2).
DATE_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
    "dd/MM/yyyy",
]

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_iso(col, as_of: Column, source_tz: str = "UTC") -> Column:
    """DATE-1: ISO datetime text; text without an offset is read in ``source_tz``;
    missing or unparsable -> ``as_of``."""
    c = _c(col)
    ts = F.try_to_timestamp(c)
    has_offset = c.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    if source_tz != "UTC":
        ts = F.when(has_offset, ts).otherwise(F.to_utc_timestamp(ts, source_tz))
    return F.coalesce(ts, as_of)


def relative_ago(col, as_of: Column) -> Column:
    """``"<n> <unit>(s) ago"`` relative to ``as_of`` (seconds .. weeks); null otherwise."""
    c = F.lower(_c(col))
    n = F.regexp_extract(c, r"^\s*(\d+)\s+(second|minute|hour|day|week)s?\s+ago\s*$", 1)
    unit = F.regexp_extract(c, r"^\s*(\d+)\s+(second|minute|hour|day|week)s?\s+ago\s*$", 2)
    secs = F.lit(None).cast("long")
    for name, mult in _UNIT_SECONDS.items():
        secs = F.when(unit == name, n.cast("long") * mult).otherwise(secs)
    return F.when(n != "", F.timestamp_seconds(F.unix_timestamp(as_of) - secs))


def parse_multi(col, as_of: Column) -> Column:
    """DATE-2: ISO first, then each format, then ``n units ago``; failures and the epoch
    itself (a zero timestamp) are ignored -> ``as_of``."""
    c = _c(col)
    cands = [F.try_to_timestamp(c)] + [F.try_to_timestamp(c, F.lit(f)) for f in DATE_FORMATS] + [relative_ago(c, as_of)]
    ts = F.coalesce(*cands)
    return F.when(ts.isNotNull() & (F.unix_timestamp(ts) != 0), ts).otherwise(as_of)


def display_date(ts) -> Column:
    """DATE-3: ``M j, Y`` (e.g. ``May 3, 2024``)."""
    return F.date_format(_c(ts), "MMM d, yyyy")
