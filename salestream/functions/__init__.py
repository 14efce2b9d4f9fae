"""Column expressions used by the operators; all of them are built-ins."""

from salestream.functions.numbers import or_zero, ratio, to_cents
from salestream.functions.text import bar, fixed2, iso_time, pad_end, pad_start
from salestream.functions.times import instant, micros, plus_micros

__all__ = [
    "bar", "fixed2", "instant", "iso_time", "micros", "or_zero", "pad_end",
    "pad_start", "plus_micros", "ratio", "to_cents",
]
