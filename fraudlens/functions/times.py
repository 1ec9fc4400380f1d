"""Event times as text, ids and durations. The text of an instant is that of the session zone; jobs require UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(duration: str) -> int:
    """Length of a literal such as ``"10 seconds"``."""
    match = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", duration)
    if not match or int(match[1]) == 0:
        raise ValueError(f"not a positive duration in seconds, minutes, hours or days: {duration!r}")
    return int(match[1]) * _UNITS[match[2]]


def time_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with a fraction only where there is one."""
    return ts.cast("string")


def second_text(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


def second_id(ts: Column, prefix: str = "TX") -> Column:
    """Record id cut from the event time: two records of one second share it."""
    return F.concat(F.lit(prefix), F.translate(second_text(ts), "- :", ""))
