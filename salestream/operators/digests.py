"""Reconciliation that looks at raw events only where digests of the windows differ.

Digests are checksums that do not depend on order: the sum of the hashes of what they cover. They form a tree of days, hours and
windows. What the events amount to is digested once, when a day is computed, and stored; later runs digest the
served table and go down only those branches that differ.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.functions import instant
from salestream.operators import reconcile
from salestream.operators.aggregate import WINDOW

DIGEST_SCHEMA = "hour int, window_start timestamp_ntz, n bigint, digest decimal(38,0), level string, day string"
#: Revenues are digested in steps of this size; equal digests mean revenues that agree for reconciliation.
STEP = reconcile.TOLERANCE / 2
_LEVELS = (("day", ("day",)), ("hour", ("day", "hour")), ("window", ("day", "hour", "window_start")))


def _marked(windows: DataFrame, step: float) -> DataFrame:
    """day, hour, window_start (wall clock of the session zone) and a hash of each row."""
    start, end = (F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end"))
    steps = F.floor(F.col("revenue") / F.lit(step) + 0.5)
    return windows.select(
        F.date_format(start, "yyyy-MM-dd").alias("day"), F.hour(start).alias("hour"), start.alias("window_start"),
        F.xxhash64(start, end, F.coalesce("category", F.lit("")), F.col("category").isNull(), "sales_count",
                   steps).cast("decimal(38,0)").alias("hash"))


def digests(windows: DataFrame, step: float = STEP) -> DataFrame:
    """One row for each day, hour and window: level, day, hour, window_start, n (rows), digest.

    Windows are summed first, hours and days from them, so one shuffle takes one row per window and map task.
    """
    by_window = _marked(windows, step).groupBy("day", "hour", "window_start").agg(
        F.count(F.lit(1)).alias("n"), F.sum("hash").alias("digest"))
    rolled = by_window.rollup("day", "hour", "window_start").agg(
        F.sum("n").alias("n"), F.sum("digest").cast("decimal(38,0)").alias("digest"), F.grouping_id().alias("up"))
    level = F.when(F.col("up") == 0, "window").when(F.col("up") == 1, "hour").otherwise("day")
    return rolled.where("up IN (0, 1, 3)").select("hour", "window_start", "n", "digest", level.alias("level"), "day")


def write_digests(windows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store the digests of computed windows; days that are there already are replaced, others stay."""
    digests(windows).write.format(fmt).partitionBy("level", "day").option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").save(path)


def read_digests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(DIGEST_SCHEMA).load(path)


def _differing(served: DataFrame, expected: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    sides = served.select(*keys, "n", "digest").unionByName(
        expected.select(*keys, (-F.col("n")).alias("n"), (-F.col("digest")).alias("digest")))
    both = sides.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("digest").alias("digest"))
    return both.where("n <> 0 OR digest <> 0").select(*keys)


def differing_windows(served: DataFrame, expected: DataFrame, step: float = STEP) -> tuple[list[str], DataFrame]:
    """The days that differ, and day, hour, window_start of the windows that do.

    ``expected`` is a stored digest table: of days that agree only the one row of the day is read.
    """
    ours = digests(served, step)
    at = lambda level: ours.where(F.col("level") == level)
    stored = lambda level, days: expected.where((F.col("level") == level) & F.col("day").isin(days))
    days = _differing(at("day"), expected.where(F.col("level") == "day"), ("day",)).agg(
        F.sort_array(F.collect_set("day"))).first()[0]  # as many as days
    found = at("day").select("day").where(F.col("day").isin(days))
    for level, keys in _LEVELS[1:]:
        above = list(keys[:-1])
        mine, theirs = at(level).where(F.col("day").isin(days)), stored(level, days)
        if level == "window":
            mine, theirs = (side.join(found, above, "left_semi") for side in (mine, theirs))
        found = _differing(mine, theirs, keys)
    return days, found


def _within(time: Column, days: list[str], time_type) -> Column:
    """Whether a time is in one of the days, as ranges that reach the scan."""
    out, spans = F.lit(False), []
    for day in map(date.fromisoformat, days):
        if spans and spans[-1][1] == day:
            spans[-1] = (spans[-1][0], day + timedelta(days=1))
        else:
            spans.append((day, day + timedelta(days=1)))
    for first, stop in spans:
        out = out | ((time >= instant(f"{first} 00:00:00", time_type)) & (time < instant(f"{stop} 00:00:00", time_type)))
    return out


def pruned_diff(
    served: DataFrame,
    events: DataFrame,
    expected: DataFrame,
    width: str = WINDOW,
    step: float = STEP,
) -> DataFrame:
    """:func:`reconcile.diff`, recomputing only windows whose digests differ; the same rows, if ``expected`` is up to date.

    ``events`` are read in the time ranges of days that differ, and summed for the windows that differ. Windows do not overlap.
    """
    days, windows = differing_windows(served, expected, step)
    time_type = events.schema["event_time"].dataType
    some = events.where(_within(F.col("event_time"), days, time_type))
    some = some.withColumn("_start", F.window("event_time", width)["start"].cast("timestamp_ntz"))
    starts = windows.select(F.col("window_start").alias("_start"))
    some = some.join(starts, "_start", "left_semi").drop("_start")
    served_type = served.schema["window_start"].dataType
    shown = served.where(_within(F.col("window_start"), days, served_type))
    shown = shown.withColumn("_start", F.col("window_start").cast("timestamp_ntz")).join(
        starts, "_start", "left_semi").drop("_start")
    return reconcile.diff(shown, some, width)
