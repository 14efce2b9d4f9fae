from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed2(value: Column) -> Column:
    return F.format_string("%.2f", value)


def pad_end(text: Column, width: int) -> Column:
    """Fill up with blanks on the right; unlike ``rpad`` long text stays whole."""
    return F.format_string(f"%-{width}s", text)


def pad_start(text: Column, width: int) -> Column:
    """Fill up with blanks on the left; unlike ``lpad`` long text stays whole."""
    return F.format_string(f"%{width}s", text)


def bar(percent: Column) -> Column:
    """One block for every two percent, halves rounded up."""
    return F.repeat(F.lit("█"), F.floor(percent / 2 + F.lit(0.5)).cast("int"))


def iso_time(timestamp: Column) -> Column:
    """ISO-8601 without zone: six fraction digits, or none for a whole second."""
    text = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")
