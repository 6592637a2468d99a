"""Calendar buckets for time-based trends.

Labels follow the pandas resample conventions of the rebuilt tool:
``D`` midnight of the day, ``W`` the Sunday that ends a Monday-Sunday week,
``ME``/``QE``/``YE`` the last day of month/quarter/year, ``MS`` the first
day of the month, ``h`` the hour. Output is ``timestamp_ntz``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

FREQS = ("h", "D", "W", "MS", "ME", "QE", "YE")


def multiple(freq: str) -> tuple[int, str] | None:
    """(count, unit) of a multiple of hours or days; None for a plain label."""
    m = re.fullmatch(r"(\d+)(h|D)", freq)
    if not m:
        return None
    if int(m[1]) < 1:
        raise ValueError(f"unsupported freq {freq!r}")
    return int(m[1]), m[2]


def bucket_from(ts: Column | str, freq: str, origin: Column) -> Column:
    """Start of the ``freq`` multiple that holds ``ts``, counted from midnight of ``origin``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    n, unit = multiple(freq)
    width = n * (3600 if unit == "h" else 86400) * 1_000_000
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    start = us(F.date_trunc("day", origin))
    return F.timestamp_micros(start + F.floor((us(ts) - start) / width) * width).cast("timestamp_ntz")


def bucket(ts: Column | str, freq: str = "D") -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    if freq == "h":
        return F.date_trunc("hour", ts).cast("timestamp_ntz")
    if freq == "D":
        return F.date_trunc("day", ts).cast("timestamp_ntz")
    if freq == "W":
        monday = F.date_trunc("week", ts).cast("date")
        return F.date_add(monday, 6).cast("timestamp_ntz")
    if freq == "MS":
        return F.date_trunc("month", ts).cast("timestamp_ntz")
    if freq == "ME":
        return F.last_day(ts).cast("timestamp_ntz")
    if freq == "QE":
        q_start = F.date_trunc("quarter", ts).cast("date")
        return F.date_sub(F.add_months(q_start, 3), 1).cast("timestamp_ntz")
    if freq == "YE":
        y_start = F.date_trunc("year", ts).cast("date")
        return F.date_sub(F.add_months(y_start, 12), 1).cast("timestamp_ntz")
    raise ValueError(f"unsupported freq {freq!r}; use one of {FREQS}, or a multiple of h or D")
