"""Live job: messages -> windowed sales -> emission log, final windows or documents.

    PYTHONPATH=. spark-submit salestream/jobs/stream_job.py --source kafka \\
        --source-option kafka.bootstrap.servers=HOST:PORT --source-option subscribe=TOPIC \\
        --sink log --sink-path PATH --checkpoint PATH
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salestream import streaming
from salestream.functions import micros
from salestream.jobs.common import (
    add_session_arguments,
    add_source_arguments,
    key_value,
    session,
)
from salestream.operators.aggregate import WATERMARK, chained_windows, pane_width, windowed_sales
from salestream.operators.parse import parse_events
from salestream.sinks.batch import ROWS_PER_FILE
from salestream.sources import read_stream

#: At least so often the job looks whether a query has failed.
WAKE_SECONDS = 10


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stream_job", description=__doc__)
    add_source_arguments(p)
    p.add_argument("--watermark", default=WATERMARK)
    p.add_argument("--sink", choices=("log", "final", "documents", "deltas"), default="log")
    p.add_argument("--sink-format", default="parquet")
    p.add_argument(
        "--sink-option", type=key_value, action="append", default=[], metavar="KEY=VALUE"
    )
    p.add_argument("--sink-path", help="where log and final windows are written")
    p.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    p.add_argument("--checkpoint", required=True)
    p.add_argument(
        "--ignore-data-loss", action="store_true",
        help="go on when the broker has dropped offsets that were not yet read",
    )
    p.add_argument("--late-path", help="where events that come too late are kept (sink log)")
    p.add_argument("--progress-path", help="where the figures of every micro-batch are kept")
    p.add_argument("--rejects-path", help="where messages that lack a field are written")
    p.add_argument("--rejects-checkpoint")
    p.add_argument("--available-now", action="store_true", help="stop at the present end")
    p.add_argument("--trigger-interval", help="e.g. '30 seconds'; default is back to back")
    p.add_argument("--name", default="windowed-sales")
    p.add_argument("--timeout", type=int, help="seconds to run; default is until stopped")
    add_session_arguments(p)
    return p


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = parser()
    args = p.parse_args(argv)
    if args.sink not in ("documents", "deltas") and not args.sink_path:
        p.error("--sink-path is required for --sink log and final")
    if args.late_path and args.sink != "log":
        p.error("--late-path needs --sink log")
    if args.available_now and args.trigger_interval:
        p.error("--available-now and --trigger-interval exclude each other")
    if bool(args.rejects_path) != bool(args.rejects_checkpoint):
        p.error("--rejects-path and --rejects-checkpoint belong together")
    starts = dict(args.source_option)
    if args.rejects_path and args.source == "kafka" and not (
        starts.keys() & {"startingTimestamp", "startingOffsetsByTimestamp"}
        or starts.get("startingOffsets", "latest") != "latest"
    ):
        p.error(
            "rejects are a query of their own; state a fixed startingOffsets or startingTimestamp, "
            "so that both cover the same messages")
    return args


def messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = dict(args.source_option)
    if args.ignore_data_loss:
        options.setdefault("failOnDataLoss", "false")
    return read_stream(spark, args.source, options, args.source_schema, args.source_path)


def trigger_of(args: argparse.Namespace) -> dict[str, object] | None:
    if args.available_now:
        return {"availableNow": True}
    if args.trigger_interval:
        return {"processingTime": args.trigger_interval}
    return None


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """With ``--slide``, a log gets panes, from which ``report_job --slide`` makes the windows, and final windows are summed
    from panes within the stream; events are copied to overlapping windows for documents only."""
    events = streaming.observed(parse_events(messages(spark, args)))
    slides = bool(args.slide) and micros(args.slide) != micros(args.width)
    width = pane_width(args.width, args.slide) if slides else args.width
    run = {"checkpoint": args.checkpoint, "trigger": trigger_of(args), "name": args.name}
    output = {"fmt": args.sink_format, "options": dict(args.sink_option)}
    if args.sink == "documents":
        windows = windowed_sales(events, args.width, args.slide, watermark=args.watermark)
        return streaming.start_document_append(windows, **output, **run)
    if args.sink == "deltas":
        windows = windowed_sales(events, args.width, args.slide, watermark=args.watermark)
        return streaming.start_delta_append(windows, **output, **run)
    if args.sink == "final":
        windows = (
            chained_windows(events, args.width, args.slide, args.watermark) if slides
            else windowed_sales(events, width, watermark=args.watermark))
        return streaming.start_final_windows(windows, args.sink_path, **output, **run)
    if args.late_path:
        return streaming.start_update_log_with_late(
            events, args.sink_path, args.late_path, width=width, watermark=args.watermark,
            rows_per_file=args.rows_per_file, **output, **run)
    return streaming.start_update_log(
        windowed_sales(events, width, watermark=args.watermark), args.sink_path,
        rows_per_file=args.rows_per_file, **output, **run)


def start_rejects(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    return streaming.start_rejects(
        parse_events(messages(spark, args), keep_raw=True),
        args.rejects_path,
        args.rejects_checkpoint,
        trigger=trigger_of(args),
        name=f"{args.name}-rejects",
    )


def run_until_ended(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until all queries have ended or ``timeout`` seconds have passed for all of them together.

    The first that fails stops the others, and its error is raised.
    """
    until = None if timeout is None else time.monotonic() + timeout
    try:
        while any(q.isActive for q in queries):
            left = None if until is None else until - time.monotonic()
            if left is not None and left <= 0:
                break
            spark.streams.resetTerminated()
            if any(not q.isActive and q.exception() for q in queries):
                break
            if all(q.isActive for q in queries):
                spark.streams.awaitAnyTermination(min(WAKE_SECONDS, left or WAKE_SECONDS))
            else:
                next(q for q in queries if q.isActive).awaitTermination(min(1, left or 1))
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        if query.exception():
            raise query.exception()


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    spark = session("sales-stream", args, streaming.STATE_STORE_CONF)
    with ExitStack() as stack:
        if args.progress_path:
            stack.enter_context(streaming.record_progress(spark, args.name, args.progress_path))
        running = [start(spark, args)]
        if args.rejects_path:
            running.append(start_rejects(spark, args))
        run_until_ended(spark, running, args.timeout)


if __name__ == "__main__":
    main()
