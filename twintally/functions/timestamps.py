"""Time functions: raw text -> instants, zone shifts, business dates.

All are built-in Column expressions (JVM side, inside whole-stage codegen).
Raw text goes through ``try_*`` forms so a bad value becomes NULL that the
quarantine split can see, instead of failing the job under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FeedSpec


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_epoch_millis(raw) -> Column:
    """Epoch milliseconds (text or number) -> instant, exact to the milli."""
    return F.timestamp_millis(_c(raw).try_cast("bigint"))


def parse_with_pattern(raw, pattern: str) -> Column:
    """Text -> timestamp with a Spark datetime pattern; NULL when unparsable."""
    return F.try_to_timestamp(_c(raw), F.lit(pattern))


def parse_offset(raw, pattern: str = "yyyy-MM-dd'T'HH:mm:ssXXX") -> Column:
    """ISO-8601 text with an offset (``+04:00`` or ``Z``) -> instant."""
    return parse_with_pattern(raw, pattern)


def parse_naive(raw, pattern: str) -> Column:
    """Zone-less local text -> wall-clock timestamp (zone applied later)."""
    return parse_with_pattern(raw, pattern)


def to_utc(ts, tz) -> Column:
    """Local wall clock in zone ``tz`` (a name or a column) -> UTC instant."""
    return F.to_utc_timestamp(_c(ts), tz if isinstance(tz, (str, Column)) else str(tz))


def from_utc(ts, tz) -> Column:
    """UTC instant -> wall clock in zone ``tz`` (audit copy)."""
    return F.from_utc_timestamp(_c(ts), tz)


def business_date(ts_utc) -> Column:
    """UTC instant -> business date (session zone is pinned to UTC)."""
    return F.to_date(_c(ts_utc))


def parse_feed_time(raw, feed: FeedSpec) -> tuple[Column, Column]:
    """Return ``(txn_ts_utc, txn_ts_local)`` for one feed's raw time text."""
    if feed.ts_format == "epoch_millis":
        inst = parse_epoch_millis(raw)
        return inst, from_utc(inst, feed.timezone)
    if feed.ts_is_instant:
        inst = parse_offset(raw, feed.parse_pattern)
        return inst, from_utc(inst, feed.timezone)
    wall = parse_naive(raw, feed.parse_pattern)
    return to_utc(wall, feed.timezone), wall


def month_bucket(d) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_c(d), "MM")
