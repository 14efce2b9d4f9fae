"""The six reports over an emission log or a table of windowed sales.

    PYTHONPATH=. spark-submit salestream/jobs/report_job.py --log-path PATH

With ``--output-path`` Spark writes all six as text. The driver prints the bounded ones, and of
the two that have a line for every category the first ``--lines``.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from salestream.jobs.common import add_session_arguments, session
from salestream.operators import manifest, serving, text_report
from salestream.operators.aggregate import WINDOW, sliding_windows

# Headings of the printed reports.
HEADINGS = (
    ("1. ÚLTIMAS 10 JANELAS PROCESSADAS", text_report.latest_windows),
    ("2. FATURAMENTO TOTAL POR CATEGORIA", text_report.revenue_by_category),
    ("3. TOP 5 JANELAS COM MAIOR FATURAMENTO", text_report.top_windows),
    ("4. EVOLUÇÃO TEMPORAL DO FATURAMENTO", text_report.time_evolution),
    ("5. ESTATÍSTICAS GERAIS", text_report.general_stats),
    ("6. DISTRIBUIÇÃO DE VENDAS POR CATEGORIA (%)", text_report.category_distribution),
)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="report_job", description=__doc__)
    given = p.add_mutually_exclusive_group(required=True)
    given.add_argument("--log-path", help="emission log of an update-mode stream")
    given.add_argument("--windows-path", help="final windows, or output of the batch job")
    p.add_argument("--format", default="parquet")
    p.add_argument(
        "--every-emission", action="store_true",
        help="count each emission of the log, as an append-only store does",
    )
    p.add_argument("--width", default=WINDOW)
    p.add_argument("--slide", help="the log has panes; make windows of --width every --slide of them")
    p.add_argument("--output-path", help="folder for the whole reports, as text")
    p.add_argument("--lines", type=int, default=1000, help="lines printed of a report at most")
    add_session_arguments(p)
    return p


def current_windows(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """A log is read with its compacted table, wherever its manifest says that is."""
    if args.windows_path:
        return serving.read_windows(spark, args.windows_path, args.format)
    if args.every_emission:
        found = manifest.read(spark, args.log_path)
        if found is not None and found.folded is not None:
            raise SystemExit("the log is compacted: earlier emissions of its windows are no longer kept")
        return serving.read_log(spark, args.log_path, args.format)
    windows = serving.latest(serving.read_current(spark, args.log_path, fmt=args.format))
    return sliding_windows(windows, args.width, args.slide) if args.slide else windows


def write(windows: DataFrame, path: str) -> None:
    """Each report as text files in a folder of its own."""
    for number, (_, report) in enumerate(HEADINGS, 1):
        report(windows).select("line").write.mode("overwrite").text(f"{path}/report={number}")


def lines(windows: DataFrame, most: int) -> Iterator[str]:
    """Report by report, ``most`` lines of each; a last line says if there are more."""
    for heading, report in HEADINGS:
        yield heading
        found = report(windows).take(most + 1)
        yield from (row["line"] for row in found[:most])
        if len(found) > most:
            yield f"... (only the first {most} lines; --output-path writes all)"
        yield ""


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session("sales-reports", args)
    windows = current_windows(spark, args).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if args.output_path:
            write(windows, args.output_path)
        for line in lines(windows, args.lines):
            print(line)
    finally:
        windows.unpersist()


if __name__ == "__main__":
    main()
