from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import SparkSession

from salestream.operators.aggregate import WINDOW


# Files then hold statistics of the window bounds, so that looking up a window
# skips row groups; the default INT96 form has none.
TABLE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


def key_value(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not found or not key:
        raise argparse.ArgumentTypeError(f"expected KEY=VALUE, got {text!r}")
    return key, value


def add_source_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--source", required=True, help="source format, e.g. kafka or text")
    parser.add_argument(
        "--source-option", type=key_value, action="append", default=[], metavar="KEY=VALUE"
    )
    parser.add_argument("--source-path", help="folder of a file source")
    parser.add_argument("--source-schema", help="DDL schema of a file source with a column value")
    parser.add_argument("--width", default=WINDOW)
    parser.add_argument(
        "--slide",
        help="defaults to the width: windows do not overlap. A log gets panes, from which the report job makes the "
             "windows",
    )


def add_session_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--time-zone", default="UTC", help="zone of event times without offset")
    parser.add_argument(
        "--shuffle-partitions", type=int,
        help="for a stream this is fixed by the first run of its checkpoint",
    )


def session(
    name: str, args: argparse.Namespace, conf: Mapping[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    settings = {"spark.sql.session.timeZone": args.time_zone, **TABLE_CONF, **(conf or {})}
    if args.shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
