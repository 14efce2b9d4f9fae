"""Batch layer: the same messages, read as a bounded table, to windowed sales.

    PYTHONPATH=. spark-submit salestream/jobs/batch_job.py --source text --source-path PATH \\
        --sink-path PATH --rejects-path PATH
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from salestream import files
from salestream.jobs.common import add_session_arguments, add_source_arguments, session
from salestream.operators.aggregate import windowed_sales
from salestream.operators.parse import classified, parse_events
from salestream.sinks import write_windows
from salestream.sources import read_batch
from salestream.workspace import new_path


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="batch_job", description=__doc__)
    add_source_arguments(p)
    p.add_argument("--sink-path", required=True, help="folder for the windowed sales")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument("--rejects-path", help="folder for messages that lack a field")
    p.add_argument(
        "--no-panes", action="store_true",
        help="copy events to overlapping windows instead of summing panes first; faster only if "
             "most windows hold about one event (wide category sets, sparse times)",
    )
    add_session_arguments(p)
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """With rejects, messages are read and parsed once, into a table in the shared folder from
    which both outputs are made: they cover the same messages even if the topic grows."""
    messages = read_batch(
        spark, args.source, dict(args.source_option), args.source_schema, args.source_path
    )
    events, parsed_path = parse_events(messages, keep_raw=bool(args.rejects_path)), None
    if args.rejects_path:
        events = classified(events)
        parsed_path = new_path(spark, "parsed-events")
        events.write.parquet(parsed_path)
        events = spark.read.schema(events.schema).parquet(parsed_path)
    windows = windowed_sales(events, args.width, args.slide, panes=not args.no_panes)
    # Files in time order: a lookup of one window opens few of them.
    write_windows(windows, args.sink_path, args.sink_format)
    if args.rejects_path:
        rejected = events.filter(F.col("reject_reason").isNotNull())
        rejected.select("raw", "reject_reason").write.format(args.sink_format).mode(
            "overwrite"
        ).save(args.rejects_path)
        files.delete(spark, parsed_path)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(session("sales-batch", args), args)


if __name__ == "__main__":
    main()
