"""Column expressions shared by sources and transforms.

Everything here returns a ``Column`` built from Spark's own functions, so it
stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NULL_TOKENS

# Fixed value: the numeric text that is accepted as a number (optional sign,
# digits with optional fraction or a bare fraction, optional exponent, or
# inf/infinity). Everything else (``1,000``, ``0x1A``, ``1.0d``, ``True``)
# becomes null.
NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(inf|infinity)$"

# Timestamp text layouts tried in order after ISO forms
# (month-first wins over day-first for ambiguous dates like 03/04/2024).
TIMESTAMP_LAYOUTS = [
    "M/d/yyyy[ H:mm[:ss[.SSSSSS]]]",
    "M/d/yyyy h:mm[:ss] a",
    "d/M/yyyy[ H:mm[:ss[.SSSSSS]]]",
    "yyyy/M/d[ H:mm[:ss[.SSSSSS]]]",
    "M.d.yyyy[ H:mm[:ss[.SSSSSS]]]",
    "d.M.yyyy[ H:mm[:ss[.SSSSSS]]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "yyyyMMdd",
]
# Text of so many digits is a count of nanoseconds since 1970.
EPOCH_NS = r"^\d{12,19}$"


def strip(c: Column | str) -> Column:
    """Without white space of any kind (tabs too) at both ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c, F.lit(" \t\n\r\x0b\x0c"))


def clean_header(name: str, json_style: bool = False) -> str:
    """Strip, lower-case, turn blank runs (and dots for JSON) into ``_``.

    Works on column *names* only, on the driver; no data passes through.
    """
    pattern = r"[\.\s]+" if json_style else r"\s+"
    return re.sub(pattern, "_", name.strip().lower())


def null_if_token(c: Column | str) -> Column:
    """Null for the text values that count as missing in delimited input."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(NULL_TOKENS), F.lit(None)).otherwise(c)


def nan_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_number(c: Column | str) -> Column:
    """Text -> double with pandas ``to_numeric(errors='coerce')`` semantics.

    Bad text gives null; NaN gives null so that it can not poison averages.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = strip(c.cast("string"))
    ok = t.rlike("(?i)" + NUMERIC_TEXT)
    return nan_to_null(F.when(ok, t.try_cast("double")))


def to_timestamp_any(c: Column | str) -> Column:
    """Text -> timestamp_ntz; unparseable -> null.

    ISO forms (``2024-03-01 08:00:00``, ``2024-03-01T08:00:00``, dates) go
    through the default parser, then the fixed layouts are tried in order.
    A text with an offset (``+02:00``, ``Z``) is shifted to UTC; one of 12 to
    19 digits is nanoseconds since 1970.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = strip(c.cast("string"))
    epoch = F.when(t.rlike(EPOCH_NS), F.timestamp_micros(F.floor(t.try_cast("decimal(19,0)") / 1000).cast("long")))
    iso = F.when(~t.rlike(EPOCH_NS), F.try_to_timestamp(t))
    tries = [iso, epoch] + [F.try_to_timestamp(t, F.lit(p)) for p in TIMESTAMP_LAYOUTS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def normalize_position(c: Column | str) -> Column:
    """Upper-case trimmed text; a missing position reads ``NAN``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.upper(strip(c.cast("string"))), F.lit("NAN"))
