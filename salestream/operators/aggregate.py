"""Revenue and volume per time window and category, for tables and streams."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestream.functions import instant, micros, plus_micros

# Window length and lateness bound of the live job.
WINDOW = "1 minute"
WATERMARK = "2 minutes"


def windowed_sales(
    events: DataFrame,
    width: str = WINDOW,
    slide: str | None = None,
    watermark: str = WATERMARK,
    counted: str = "sale_id",
    panes: bool = True,
) -> DataFrame:
    """Sum of ``amount`` and number of non-NULL ``sale_id`` per (window, category).

    Windows are ``[start, end)`` and overlap when ``slide`` is shorter than ``width``.
    They are aligned to the epoch; for times without a zone, to 1970-01-01 00:00 on the
    wall clock, on a table and on a stream alike (a stream returns the bounds as
    TIMESTAMP of the session zone). A stream with overlapping windows copies each event
    to all of them; log its panes instead and use :func:`sliding_windows` on reading.
    Events without a time belong to no window and are
    dropped. ``watermark`` bounds lateness on a stream and has no effect on a table.
    Where every event is known to have an id, ``counted="event_time"`` gives the
    same counts and spares reading the ids, often the widest column of a table.
    ``panes=False`` expands the events of a table instead of pre-summing them for
    overlapping windows; worthwhile only if most windows hold a single event.
    Returns window_start, window_end, category, revenue, sales_count.
    """
    if events.isStreaming:
        return _stream_windows(events, width, slide or width, watermark, counted)
    return _table_windows(events, width, slide or width, counted, panes)


def _totals(events: DataFrame, counted: str, *keys: Column | str) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.sum("amount").alias("revenue"), F.count(counted).alias("sales_count")
    )


def timed(events: DataFrame, watermark: str) -> tuple[DataFrame, Column, Column]:
    """Stream events with a watermark, and the bounds of their column ``window`` once they have one.

    A watermark needs a TIMESTAMP: a wall-clock time is taken as if it were UTC while windows are found.
    """
    time, start, end = F.col("event_time"), F.col("window.start"), F.col("window.end")
    if isinstance(events.schema["event_time"].dataType, T.TimestampNTZType):
        zone = F.lit(events.sparkSession.conf.get("spark.sql.session.timeZone"))
        time = F.from_utc_timestamp(time.cast("timestamp"), zone)
        start, end = F.to_utc_timestamp(start, zone), F.to_utc_timestamp(end, zone)
    return events.withColumn("event_time", time).withWatermark("event_time", watermark), start, end


def _stream_windows(
    events: DataFrame, width: str, slide: str, watermark: str, counted: str
) -> DataFrame:
    # The whole window struct is the key: it carries the watermark that lets
    # Spark drop finished windows from the state.
    marked, start, end = timed(events, watermark)
    return _totals(marked, counted, F.window("event_time", width, slide), "category").select(
        start.alias("window_start"),
        end.alias("window_end"),
        "category",
        "revenue",
        "sales_count",
    )


def chained_windows(
    events: DataFrame,
    width: str,
    slide: str,
    watermark: str = WATERMARK,
    counted: str = "sale_id",
) -> DataFrame:
    """Overlapping windows of a stream that are final when they appear, made of panes.

    Two stateful steps in one query, for append mode (``streaming.start_final_windows``): events are summed to panes,
    and the windows are summed from panes as the watermark closes them. Each event updates one pane; only the rows of
    closed panes are copied to the windows that cover them. State holds the open panes, and per window one row.
    """
    marked, start, end = timed(events, watermark)
    pane = F.window("event_time", pane_width(width, slide)).alias("pane")
    panes = _totals(marked, counted, pane, "category")
    window = F.window(F.col("pane"), width, slide).alias("window")
    summed = panes.groupBy(window, "category").agg(
        F.sum("revenue").alias("revenue"), F.sum("sales_count").alias("sales_count"))
    return summed.select(
        start.alias("window_start"), end.alias("window_end"), "category", "revenue", "sales_count")


def _table_windows(
    events: DataFrame, width: str, slide: str, counted: str, panes: bool
) -> DataFrame:
    # Only the start is a grouping key: one fixed-width value hashes and shuffles
    # faster than the struct, and the end follows from it.
    length, step = micros(width), micros(slide)
    if panes and step < length:
        # Windows that overlap are unions of whole panes. Aggregating the panes
        # first means each event is touched once, and only the few pane rows are
        # copied into the windows they belong to.
        pane = F.window("event_time", pane_width(width, slide))["start"].alias("window_start")
        return sliding_windows(_totals(events, counted, pane, "category"), width, slide)
    start = F.window("event_time", width, slide)["start"].alias("window_start")
    windows = _totals(events, counted, start, "category")
    time_type = events.schema["event_time"].dataType
    return windows.select(
        "window_start",
        plus_micros(F.col("window_start"), length, time_type).alias("window_end"),
        "category",
        "revenue",
        "sales_count",
    )


def pane_width(width: str, slide: str) -> str:
    """The longest pane of which all windows of ``width`` every ``slide`` are unions."""
    return f"{math.gcd(micros(width), micros(slide))} microseconds"


def sliding_windows(panes: DataFrame, width: str, slide: str) -> DataFrame:
    """Windows of ``width`` every ``slide`` from windowed sales as wide as their pane.

    ``panes`` has one row per pane and category, such as ``serving.latest`` of a log
    to which a stream writes windows of ``pane_width(width, slide)``.
    """
    time_type = panes.schema["window_start"].dataType
    start = F.window("window_start", width, slide)["start"].alias("start")
    summed = panes.groupBy(start, "category").agg(
        F.sum("revenue").alias("revenue"), F.sum("sales_count").alias("sales_count"))
    return summed.select(
        F.col("start").alias("window_start"),
        plus_micros(F.col("start"), micros(width), time_type).alias("window_end"),
        "category",
        "revenue",
        "sales_count",
    )


def events_in_window(
    events: DataFrame,
    category: str,
    window_start: datetime | str | Column,
    width: str = WINDOW,
) -> DataFrame:
    """Raw events of one category in one window.

    The window is stated as a range of event times, which reaches the file scan;
    a filter on the computed window start would not. Parquet row groups outside
    the range are skipped if times are stored as TIMESTAMP in microseconds (not
    for TIMESTAMP_NTZ and INT96, which Spark reads through and filters).
    """
    time_type = events.schema["event_time"].dataType
    start = instant(window_start, time_type)
    return events.filter(
        (F.col("category") == category)
        & (F.col("event_time") >= start)
        & (F.col("event_time") < plus_micros(start, micros(width), time_type))
    )
