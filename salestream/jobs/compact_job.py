"""Fold the batches of an emission log into its compacted table; the stream may go on writing.

    PYTHONPATH=. spark-submit salestream/jobs/compact_job.py --log-path PATH --table-path PATH

``--drop`` also deletes what is folded; give it when no reader started before the last compaction is still at work.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from salestream.jobs.common import add_session_arguments, session
from salestream.operators import serving


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="compact_job", description=__doc__)
    p.add_argument("--log-path", required=True)
    p.add_argument("--table-path", required=True)
    p.add_argument("--format", default="parquet")
    p.add_argument("--drop", action="store_true", help="delete what the table holds by now")
    add_session_arguments(p)
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> int | None:
    last = serving.compact(spark, args.log_path, args.table_path, args.format)
    if args.drop:
        serving.drop_folded(spark, args.log_path, args.table_path)
    return last


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    run(session("sales-compaction", args), args)


if __name__ == "__main__":
    main()
