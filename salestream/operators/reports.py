"""Business reports over a table of windowed sales.

Input is the *current* table (one row per window and category, see
``serving.latest``). Given the raw emission log instead, the reports count every
emission of a window, as an append-only store would show them. Orderings compare
revenue in cents, since the last bits of a sum depend on its order, and have
tie-breaks, so a limit always keeps the same rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestream.functions import instant, or_zero, ratio, to_cents
from salestream.schema import WINDOW_COLUMNS


def _by_recency() -> tuple[Column, Column]:
    return F.desc("window_start"), F.asc("category")


def _by_revenue() -> Column:
    return to_cents(F.col("revenue")).desc()


def _revenue() -> Column:
    return or_zero(F.sum("revenue"))


def latest_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recent rows."""
    return windows.select(*WINDOW_COLUMNS).orderBy(*_by_recency()).limit(n)


def top_windows(windows: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` rows with the highest revenue."""
    return windows.select(*WINDOW_COLUMNS).orderBy(_by_revenue(), *_by_recency()).limit(n)


def revenue_by_category(windows: DataFrame) -> DataFrame:
    """Revenue, volume and average ticket per category, best first.

    ``avg_ticket`` is the mean over windows of revenue per sale; windows without
    a counted sale do not enter it. ``weighted_ticket`` is total over total.
    """
    return (
        windows.groupBy("category")
        .agg(
            _revenue().alias("revenue"),
            F.sum("sales_count").alias("sales_count"),
            F.avg(ratio(F.col("revenue"), F.col("sales_count"))).alias("avg_ticket"),
        )
        .orderBy(_by_revenue(), "category")
        .select(
            "category",
            to_cents(F.col("revenue")).alias("revenue"),
            "sales_count",
            to_cents(F.col("avg_ticket")).alias("avg_ticket"),
            to_cents(ratio(F.col("revenue"), F.col("sales_count"))).alias("weighted_ticket"),
        )
    )


def time_evolution(windows: DataFrame, n_rows: int = 20) -> DataFrame:
    """Revenue and volume per window start over the ``n_rows`` most recent *rows*.

    Rows are cut before grouping, so the oldest window may be incomplete.
    """
    recent = windows.orderBy(*_by_recency()).limit(n_rows)
    return (
        recent.groupBy("window_start")
        .agg(
            to_cents(_revenue()).alias("revenue"),
            F.sum("sales_count").alias("sales_count"),
        )
        .orderBy("window_start")
    )


def general_stats(windows: DataFrame) -> DataFrame:
    """One row of totals, means and extremes; no row for an empty table.

    ``n_rows`` counts window-category rows, ``n_windows`` the distinct windows.
    """
    return windows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("window_start").alias("n_windows"),
        _revenue().alias("revenue"),
        F.coalesce(F.sum("sales_count"), F.lit(0)).alias("sales_count"),
        F.avg("revenue").alias("avg_revenue"),
        F.avg("sales_count").alias("avg_sales_count"),
        F.max("revenue").alias("max_revenue"),
        F.min("revenue").alias("min_revenue"),
    ).filter(F.col("n_rows") > 0)


def category_totals(windows: DataFrame) -> DataFrame:
    """Revenue per category."""
    return windows.groupBy("category").agg(_revenue().alias("revenue"))


def category_distribution(windows: DataFrame) -> DataFrame:
    """Revenue per category and its share of the grand total in percent.

    The total is a scalar subquery over the grouped rows. Spark runs the grouping
    once and both sides read its shuffle output, and no task has to hold all
    categories, as it would with an unpartitioned window function.
    """
    totals = category_totals(windows)
    grand_total = totals.agg(F.sum("revenue").alias("total")).scalar()
    return totals.select(
        "category",
        "revenue",
        (ratio(F.col("revenue"), grand_total) * 100).alias("percent"),
    ).orderBy(_by_revenue(), "category")


def top_categories(windows: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` categories with the highest revenue, with their volume."""
    return (
        windows.groupBy("category")
        .agg(_revenue().alias("revenue"), F.sum("sales_count").alias("sales_count"))
        .orderBy(_by_revenue(), "category")
        .limit(n)
    )


def count_rows(windows: DataFrame) -> DataFrame:
    return windows.agg(F.count(F.lit(1)).alias("n_rows"))


def find_window(
    windows: DataFrame, category: str, window_start: datetime | str | Column
) -> DataFrame:
    """The row of one category and one window start."""
    start = instant(window_start, windows.schema["window_start"].dataType)
    return windows.select(*WINDOW_COLUMNS).filter(
        (F.col("category") == category) & (F.col("window_start") == start)
    )


def anomalous_windows(windows: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Windows whose revenue is far from the mean of their category.

    ``deviation`` is the distance in standard deviations (of the sample); rows beyond
    ``deviations`` on either side are returned. A category with one window, or with
    equal revenues, has none. The statistics are joined back by category, so no task
    has to hold all windows of one; NULL categories match each other.
    """
    spread = windows.groupBy(F.col("category").alias("of")).agg(
        F.avg("revenue").alias("mean"), F.stddev_samp("revenue").alias("sd"))
    joined = windows.join(spread, F.col("category").eqNullSafe(F.col("of")))
    deviation = ratio(F.col("revenue") - F.col("mean"), F.col("sd"))
    return joined.select(*WINDOW_COLUMNS, deviation.alias("deviation")).filter(
        F.abs("deviation") > deviations)
