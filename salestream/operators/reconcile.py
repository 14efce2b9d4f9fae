"""Check served windows against the raw events they were made from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestream.functions import instant, micros, plus_micros
from salestream.operators.aggregate import WINDOW, events_in_window, windowed_sales
from salestream.operators.reports import find_window

_KEYS = ("window_start", "category")

#: Revenues agree within half a cent, as served figures may be rounded, ...
TOLERANCE = 0.005
#: ... plus this share of the larger one: the last bits of a sum depend on its order.
RELATIVE = 1e-9


def _served(windows: DataFrame) -> DataFrame:
    return windows.select(
        *_KEYS,
        F.lit("served").alias("side"),
        "revenue",
        F.col("sales_count").alias("n"),
        "window_end",
    )


def _expected(rows: DataFrame, revenue: str, n: Column) -> DataFrame:
    """Windows or single events; what adds up to a window's figures."""
    end = F.lit(None).cast(rows.schema["window_start"].dataType).alias("window_end")
    return rows.select(
        *_KEYS, F.lit("expected").alias("side"), F.col(revenue).alias("revenue"), n.alias("n"), end
    )


def _of(side: str, column: str) -> Column:
    return F.when(F.col("side") == side, F.col(column))


def _compare(
    served: DataFrame, expected: DataFrame, width: str, tolerance: float, relative: float
) -> DataFrame:
    """Both sides are stacked and grouped by key once, instead of being full-outer joined:
    grouping matches NULL categories, finds duplicate keys without multiplying rows, and
    combines before its one shuffle."""
    time_type = served.schema["window_start"].dataType
    matched = served.unionByName(expected).groupBy(*_KEYS).agg(
        F.sum(_of("served", "revenue")).alias("served_revenue"),
        F.sum(_of("expected", "revenue")).alias("expected_revenue"),
        F.coalesce(F.sum(_of("served", "n")), F.lit(0)).alias("served_count"),
        F.coalesce(F.sum(_of("expected", "n")), F.lit(0)).alias("expected_count"),
        F.count_if(F.col("side") == "served").alias("n_served"),
        F.count_if(F.col("side") == "expected").alias("n_expected"),
        F.count_if((F.col("side") == "served") & ~F.col("window_end").eqNullSafe(
            plus_micros(F.col("window_start"), micros(width), time_type))).alias("n_wrong_end"),
    )
    ours, theirs = F.col("served_revenue"), F.col("expected_revenue")
    near = F.abs(ours - theirs) <= F.lit(tolerance) + relative * F.greatest(F.abs(ours), F.abs(theirs))
    agrees = (
        F.when(ours.isNull() | theirs.isNull(), ours.isNull() & theirs.isNull()).otherwise(near)
        & (F.col("served_count") == F.col("expected_count"))
        & (F.col("n_wrong_end") == 0)
    )
    status = (
        F.when(F.col("n_served") == 0, "missing")
        .when(F.col("n_expected") == 0, "unexpected")
        .when(F.col("n_served") > 1, "duplicate")
        .when(~agrees, "different")
    )
    return (
        matched.withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .drop("n_served", "n_expected", "n_wrong_end")
    )


def diff(
    served: DataFrame,
    events: DataFrame,
    width: str = WINDOW,
    slide: str | None = None,
    tolerance: float = TOLERANCE,
    relative: float = RELATIVE,
) -> DataFrame:
    """Windows where ``served`` and a recomputation from ``events`` disagree.

    ``status`` is ``missing`` (not served), ``unexpected`` (no such events),
    ``duplicate`` (served more than once, values summed) or ``different`` (revenue, count
    or end of the window). Revenues agree within ``tolerance`` plus ``relative`` times the
    larger one; two NULLs agree.

    Events of windows that do not overlap go straight into the comparison, so they are
    shuffled once, combined; overlapping windows are summed from panes first.
    """
    if micros(slide or width) == micros(width):
        placed = events.filter(F.col("event_time").isNotNull()).withColumn(
            "window_start", F.window("event_time", width)["start"])
        expected = _expected(placed, "amount", F.col("sale_id").isNotNull().cast("long"))
    else:
        expected = _expected(windowed_sales(events, width, slide), "revenue", F.col("sales_count"))
    return _compare(_served(served), expected, width, tolerance, relative)


def check_window(
    served: DataFrame,
    events: DataFrame,
    category: str,
    window_start: datetime | str | Column,
    width: str = WINDOW,
    slide: str | None = None,
    tolerance: float = TOLERANCE,
    relative: float = RELATIVE,
) -> DataFrame:
    """:func:`diff` for one category and window; reads only that time range.

    The events of the range are the window, whatever the ``slide``; a start at which no
    window begins has no events.
    """
    found = events_in_window(events, category, window_start, width)
    start = instant(window_start, events.schema["event_time"].dataType)
    inside = (
        found.withColumn("window_start", start)
        .withColumn("begins", F.window("window_start", slide or width)["start"])
        .filter(F.col("begins") == F.col("window_start"))
    )
    expected = _expected(inside, "amount", F.col("sale_id").isNotNull().cast("long"))
    return _compare(
        _served(find_window(served, category, window_start)), expected, width, tolerance, relative)
