"""Reports as text: one column ``line`` in the order of the report.

Nothing is printed here; call ``.show(truncate=False)`` or write the lines out.
Times are shown as ``yyyy-MM-dd HH:mm:ss``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestream.functions import bar, fixed2, pad_end, pad_start
from salestream.operators import reports

# Labels and layout of the printed reports.
RULE = "─" * 61
LATEST_LAYOUT = (
    "Janela: %s → %s\nCategoria: %s\nFaturamento: R$ %s\nVolume: %s vendas\n" + RULE
)
CATEGORY_LAYOUT = (
    "Categoria: %s\n  Faturamento Total: R$ %s\n  Volume Total: %s vendas\n"
    "  Ticket Médio: R$ %s\n" + RULE
)
TOP_LAYOUT = "Janela: %s\nCategoria: %s\nFaturamento: R$ %s\nVolume: %s vendas\n" + RULE
EVOLUTION_LAYOUT = "%s | R$ %s | %s vendas"
STATS_LAYOUT = (
    "Total de Janelas Processadas: %s\nFaturamento Total: R$ %s\n"
    "Volume Total de Vendas: %s\nFaturamento Médio por Janela: R$ %s\n"
    "Volume Médio por Janela: %s vendas\nMaior Faturamento em uma Janela: R$ %s\n"
    "Menor Faturamento em uma Janela: R$ %s"
)
DISTRIBUTION_LAYOUT = "%s | %s %s%%"


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _line(layout: str, *values: Column | str) -> Column:
    return F.format_string(layout, *values).alias("line")


def latest_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    return reports.latest_windows(windows, n).select(
        _line(
            LATEST_LAYOUT, _time("window_start"), _time("window_end"), "category",
            fixed2(F.col("revenue")), "sales_count",
        )
    )


def revenue_by_category(windows: DataFrame) -> DataFrame:
    return reports.revenue_by_category(windows).select(
        _line(
            CATEGORY_LAYOUT, "category", fixed2(F.col("revenue")), "sales_count",
            fixed2(F.col("avg_ticket")),
        )
    )


def top_windows(windows: DataFrame, n: int = 5) -> DataFrame:
    return reports.top_windows(windows, n).select(
        _line(
            TOP_LAYOUT, _time("window_start"), "category",
            fixed2(F.col("revenue")), "sales_count",
        )
    )


def time_evolution(windows: DataFrame, n_rows: int = 20) -> DataFrame:
    return reports.time_evolution(windows, n_rows).select(
        _line(
            EVOLUTION_LAYOUT, _time("window_start"),
            pad_start(fixed2(F.col("revenue")), 12),
            pad_start(F.col("sales_count").cast("string"), 4),
        )
    )


def general_stats(windows: DataFrame) -> DataFrame:
    money = {c: fixed2(F.col(c)) for c in ("revenue", "avg_revenue", "max_revenue", "min_revenue")}
    return reports.general_stats(windows).select(
        _line(
            STATS_LAYOUT, "n_rows", money["revenue"], "sales_count", money["avg_revenue"],
            fixed2(F.col("avg_sales_count")), money["max_revenue"], money["min_revenue"],
        )
    )


def category_distribution(windows: DataFrame) -> DataFrame:
    return reports.category_distribution(windows).select(
        _line(
            DISTRIBUTION_LAYOUT, pad_end(F.col("category"), 15),
            bar(F.col("percent")), fixed2(F.col("percent")),
        )
    )
