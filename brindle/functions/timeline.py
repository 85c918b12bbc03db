"""Timestamps as whole microseconds, which range frames can order by.

A timestamp without zone is read in the session time zone. It must be UTC, which
``brindle.sources.tables.pin_utc`` sets, or wall-clock hours that daylight saving
skips would move.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def interval_micros(text: str) -> int:
    """``'12 hours'`` as microseconds."""
    match = re.fullmatch(r"(\d+) ([a-z]+?)s?", text.strip().lower())
    if not match or match[2] not in _UNIT_MICROS or int(match[1]) == 0:
        raise ValueError(f"not a positive interval: {text!r}")
    return int(match[1]) * _UNIT_MICROS[match[2]]
