from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Length of a window duration such as ``"1 minute"`` or ``"1 hour 30 minutes"``."""
    part = r"(\d+)\s*([a-z]+?)s?"
    if not re.fullmatch(rf"\s*(?:interval\s+)?(?:{part}(?:\s+|$))+", duration.lower()):
        raise ValueError(f"not a window duration: {duration!r}")
    parts = re.findall(rf"{part}(?:\s+|$)", duration.lower())
    if any(unit not in _UNIT_MICROS for _, unit in parts):
        raise ValueError(f"not a window duration: {duration!r}")
    return sum(int(n) * _UNIT_MICROS[unit] for n, unit in parts)


def plus_micros(timestamp: Column, length: int, data_type: T.DataType) -> Column:
    """Shift by elapsed time.

    Adding an interval of a day or more to a TIMESTAMP moves by calendar days of
    the session zone, which is 23 or 25 hours on two days of the year; windows
    are measured in elapsed time, so the sum is taken on the epoch value.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return timestamp + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.lit(length / 1_000_000)
        )
    return F.timestamp_micros(F.unix_micros(timestamp) + F.lit(length))


def instant(value: datetime | str | Column, data_type: T.DataType) -> Column:
    """A point in time as a column of the given timestamp type.

    Text and datetimes without offset are read in the session zone, like event
    times, and not in the zone of the Python process.
    """
    column = value if isinstance(value, Column) else F.lit(str(value))
    return column.cast(data_type)
