"""Unusual windows, judged by the same hour of the week on earlier days.

For each day, hour of the week and category a state of three numbers is kept: how many windows, the mean of their revenue, and
the sum of squared deviations from it. States of parts of the data merge into the state of the whole, so a
baseline is extended day by day without reading old windows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salestream.functions import ratio
from salestream.schema import WINDOW_COLUMNS

KEYS = ("day", "hour_of_week", "category")
#: Earlier windows that a judgement needs at least.
LEAST_WINDOWS = 3


def _placed(windows: DataFrame) -> DataFrame:
    """``windows`` with day and hour_of_week (0 is Monday, midnight to one) of their start, in the session zone."""
    return windows.withColumns({
        "day": F.to_date("window_start"),
        "hour_of_week": F.weekday("window_start") * 24 + F.hour("window_start"),
    })


def states(windows: DataFrame) -> DataFrame:
    """day, hour_of_week, category, n, mean, m2; windows without revenue do not count."""
    return _placed(windows.where("revenue IS NOT NULL")).groupBy(*KEYS).agg(
        F.count("revenue").alias("n"), F.avg("revenue").alias("mean"),
        (F.var_pop("revenue") * F.count("revenue")).alias("m2"))


def _joined(a: Column, b: Column) -> Column:
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))


def merge(parts: DataFrame) -> DataFrame:
    """One state for each key of the states of several parts of the data.

    A key has as many states as there are parts, and they are merged in a fixed order.
    """
    held = F.sort_array(F.collect_list(F.struct("n", "mean", "m2")))
    merged = parts.groupBy(*KEYS).agg(held.alias("held"))
    whole = F.aggregate(F.slice("held", 2, F.greatest(F.size("held") - 1, F.lit(0))), F.col("held")[0], _joined)
    return merged.select(*KEYS, whole.alias("state")).select(*KEYS, "state.*")


def anomalies(
    windows: DataFrame, baseline: DataFrame, deviations: float = 3.0, least: int = LEAST_WINDOWS
) -> DataFrame:
    """Windows whose revenue is far from the earlier ones of their hour of the week and category.

    ``baseline`` has merged states, also of days that are not judged. A window is compared with all days before its own, never with its
    own or later ones; ``deviation`` is in standard deviations of the sample. Where fewer than ``least`` windows came before,
    or all were equal, there is no judgement. Running sums go over the states of a key, one for each week of history,
    about the first mean, which keeps them exact for large revenues.
    """
    key = Window.partitionBy("hour_of_week", "category").orderBy("day")
    before = key.rowsBetween(Window.unboundedPreceding, -1)
    shift = F.col("mean") - F.first("mean").over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = baseline.withColumn("shift", shift).select(
        *KEYS,
        F.first("mean").over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("pivot"),
        F.sum("n").over(before).alias("n_before"),
        F.sum(F.col("n") * F.col("shift")).over(before).alias("s1"),
        F.sum(F.col("m2") + F.col("n") * F.col("shift") * F.col("shift")).over(before).alias("s2"),
    )
    off = ratio(F.col("s1"), F.col("n_before"))
    spread = F.sqrt(F.greatest(ratio(F.col("s2") - F.col("s1") * off, F.col("n_before") - 1), F.lit(0.0)))
    known = summed.where(F.col("n_before") >= F.lit(max(2, least))).select(
        F.col("day").alias("_day"), F.col("hour_of_week").alias("_hour"), F.col("category").alias("_category"),
        (F.col("pivot") + off).alias("expected"), spread.alias("sd"))
    placed = _placed(windows)
    same = (F.col("day") == F.col("_day")) & (F.col("hour_of_week") == F.col("_hour")) & F.col("category").eqNullSafe(F.col("_category"))
    deviation = ratio(F.col("revenue") - F.col("expected"), F.when(F.col("sd") > 0, F.col("sd")))
    return placed.join(known, same).select(*WINDOW_COLUMNS, "expected", deviation.alias("deviation")).where(
        F.abs("deviation") > deviations)
