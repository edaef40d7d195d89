"""Time conversions (P14) and duration parsing.

Event times travel as epoch milliseconds (``bigint``) at the edges, as the
reference's records do, and as ``TIMESTAMP`` (an instant) inside windows
and watermarks. Conversions never depend on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F
from pyspark.sql.types import TimestampNTZType

_UNITS_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "m": 60_000, "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


def duration_ms(d: str | int) -> int:
    """'5 hours' / '300 milliseconds' / '2s' / 1500 -> milliseconds."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNITS_MS:
        raise ValueError(f"bad duration: {d!r}")
    return int(m.group(1)) * _UNITS_MS[m.group(2).lower()]


def duration_label(d: str | int) -> str:
    """Duration as whole seconds, the way alert messages print it ('2s')."""
    ms = duration_ms(d)
    return f"{ms // 1000}s" if ms % 1000 == 0 else f"{ms}ms"


def spark_interval(d: str | int) -> str:
    """Duration string Spark's window / watermark functions accept."""
    return f"{duration_ms(d)} milliseconds"


def epoch_ms(col: Column, is_ntz: bool = False) -> Column:
    """Epoch milliseconds of a timestamp column, time-zone independent."""
    if is_ntz:
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast(TimestampNTZType()), col)
    return F.unix_millis(col)


def epoch_seconds(col: Column, is_ntz: bool = False) -> Column:
    if is_ntz:
        return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast(TimestampNTZType()), col)
    return F.unix_seconds(col)


def event_time_from_ms(col: Column) -> Column:
    """bigint epoch ms -> TIMESTAMP instant (usable by windows and watermarks)."""
    return F.timestamp_millis(col)


def event_time_from_seconds(col: Column) -> Column:
    """bigint epoch s -> TIMESTAMP; the reference's ``ts * 1000L`` step."""
    return F.timestamp_seconds(col)
