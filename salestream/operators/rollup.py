"""Reports from states that are kept by day: sums, counts, extremes, sums of ratios, and numbers of windows.

States merge by addition (extremes by extremes), so a report reads one row for each day and category instead of all windows, and a
day whose windows were corrected is computed again alone. A window belongs to the day it starts in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestream.functions import or_zero, ratio, to_cents
from salestream.operators import reports

STATE_SCHEMA = (
    "kind string, category string, revenue double, n_revenue bigint, sales_count bigint, n_counts bigint, n_rows bigint, "
    "max_revenue double, min_revenue double, ratio_sum double, n_ratios bigint, n_windows bigint, day string")


def _day():
    return F.date_format("window_start", "yyyy-MM-dd")


def day_states(windows: DataFrame) -> DataFrame:
    """One row of kind ``category`` for each day and category, and one of kind ``day`` with the number of windows."""
    dated = windows.withColumn("day", _day())
    per_sale = ratio(F.col("revenue"), F.col("sales_count"))
    figures = [
        F.sum("revenue").alias("revenue"), F.count("revenue").alias("n_revenue"), F.sum("sales_count").alias("sales_count"),
        F.count("sales_count").alias("n_counts"), F.count(F.lit(1)).alias("n_rows"), F.max("revenue").alias("max_revenue"),
        F.min("revenue").alias("min_revenue"), F.sum(per_sale).alias("ratio_sum"), F.count(per_sale).alias("n_ratios"),
    ]
    # different starts of a day are counted by grouping twice, combined before either shuffle
    starts = dated.select("day", "window_start").distinct().groupBy("day").agg(F.count(F.lit(1)).alias("n_windows"))
    by_category = dated.groupBy("day", "category").agg(*figures).withColumn("kind", F.lit("category"))
    return by_category.unionByName(starts.withColumn("kind", F.lit("day")), allowMissingColumns=True).select(
        *[c.split()[0] for c in STATE_SCHEMA.split(", ")])


def _write(states: DataFrame, path: str, fmt: str) -> None:
    states.repartition("day").write.format(fmt).partitionBy("day").option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").save(path)


def write_rollup(windows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store the states of all days of ``windows``; other days at ``path`` stay as they are."""
    _write(day_states(windows), path, fmt)


def refresh(windows: DataFrame, path: str, days: Sequence[str], fmt: str = "parquet") -> None:
    """Compute the states of some days again; days are ``yyyy-MM-dd`` and may have no windows left."""
    spark = windows.sparkSession
    named = spark.createDataFrame([(d,) for d in days], "day string")
    states = day_states(windows.where(_day().isin(list(days))))
    # a day without windows still has a row, which replaces what was there
    emptied = named.join(states.where("kind = 'day'"), "day", "left_anti").withColumns(
        {"kind": F.lit("day"), "n_windows": F.lit(0).cast("bigint")})
    _write(states.unionByName(emptied, allowMissingColumns=True), path, fmt)


def read_rollup(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(STATE_SCHEMA).load(path)


def _by_category(states: DataFrame) -> DataFrame:
    return states.where("kind = 'category'")


def revenue_by_category(states: DataFrame) -> DataFrame:
    """As :func:`reports.revenue_by_category`."""
    merged = _by_category(states).groupBy("category").agg(
        or_zero(F.sum("revenue")).alias("revenue"), F.sum("sales_count").alias("sales_count"),
        F.sum("ratio_sum").alias("ratio_sum"), F.sum("n_ratios").alias("n_ratios"))
    return merged.orderBy(to_cents(F.col("revenue")).desc(), "category").select(
        "category", to_cents(F.col("revenue")).alias("revenue"), "sales_count",
        to_cents(ratio(F.col("ratio_sum"), F.col("n_ratios"))).alias("avg_ticket"),
        to_cents(ratio(F.col("revenue"), F.col("sales_count"))).alias("weighted_ticket"))


def category_totals(states: DataFrame) -> DataFrame:
    """As :func:`reports.category_totals`."""
    return reports.category_totals(_by_category(states))


def category_distribution(states: DataFrame) -> DataFrame:
    """As :func:`reports.category_distribution`."""
    return reports.category_distribution(_by_category(states))


def top_categories(states: DataFrame, n: int = 5) -> DataFrame:
    """As :func:`reports.top_categories`."""
    return reports.top_categories(_by_category(states), n)


def general_stats(states: DataFrame) -> DataFrame:
    """As :func:`reports.general_stats`."""
    merged = states.agg(
        or_zero(F.sum("n_rows")).cast("bigint").alias("n_rows"), or_zero(F.sum("n_windows")).cast("bigint").alias("n_windows"),
        or_zero(F.sum("revenue")).alias("revenue"), F.coalesce(F.sum("sales_count"), F.lit(0)).alias("sales_count"),
        F.sum("revenue").alias("all_revenue"), F.sum("n_revenue").alias("n_revenue"), F.sum("n_counts").alias("n_counts"),
        F.max("max_revenue").alias("max_revenue"), F.min("min_revenue").alias("min_revenue"))
    return merged.where("n_rows > 0").select(
        "n_rows", "n_windows", "revenue", "sales_count",
        ratio(F.col("all_revenue"), F.col("n_revenue")).alias("avg_revenue"),
        ratio(F.col("sales_count"), F.col("n_counts")).alias("avg_sales_count"), "max_revenue", "min_revenue")
