"""The figures of every micro-batch as a table: durations, rows, watermark, state, and what the stream observed."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from salestream import files
from salestream.operators.parse import missing_field
from salestream.schema import SALE_COLUMNS

#: Name of the observation that :func:`observed` adds.
QUALITY = "event_quality"
#: Files of single micro-batches that become one.
FOLD = 100

_REPORTED = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("input_rows_per_second", T.DoubleType()),
    T.StructField("processed_rows_per_second", T.DoubleType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("max_event_time", T.StringType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("state_rows_updated", T.LongType()),
    T.StructField("late_rows_dropped", T.LongType()),
    T.StructField("max_offsets_behind", T.LongType()),
    T.StructField("observed", T.MapType(T.StringType(), T.LongType())),
])


def observed(events: DataFrame, required: Sequence[str] = SALE_COLUMNS) -> DataFrame:
    """``events`` unchanged, counted as they pass: all, valid, rejected by reason, and NULL ids.

    The counts are part of the batch's own evaluation and appear in its progress; no second pass is made.
    """
    reason = missing_field(required)
    return events.observe(
        QUALITY,
        F.count(F.lit(1)).alias("events"),
        F.count_if(reason.isNull()).alias("valid"),
        *(F.count_if(reason == F.lit(c)).alias(f"rejected_{c}") for c in required),
        F.count_if(F.col("sale_id").isNull()).alias("null_ids"),
    )


def _as_row(progress) -> tuple:
    event_time = progress.eventTime
    state = progress.stateOperators
    behind = [
        int(source.metrics["maxOffsetsBehindLatest"])
        for source in progress.sources
        if "maxOffsetsBehindLatest" in (source.metrics or {})
    ]
    quality = (progress.observedMetrics or {}).get(QUALITY)
    return (
        progress.batchId,
        progress.timestamp,
        progress.durationMs.get("triggerExecution"),
        progress.numInputRows,
        float(progress.inputRowsPerSecond),
        float(progress.processedRowsPerSecond),
        event_time.get("watermark"),
        event_time.get("max"),
        sum(op.numRowsTotal for op in state),
        sum(op.numRowsUpdated for op in state),
        sum(op.numRowsDroppedByWatermark for op in state),
        max(behind, default=None),
        quality.asDict() if quality else {},
    )


def _timed(rows: DataFrame) -> DataFrame:
    times = {c: F.try_to_timestamp(c) for c in ("started_at", "watermark", "max_event_time")}
    return rows.withColumns(times).withColumn(
        "watermark_delay_ms",
        F.unix_millis("max_event_time") - F.unix_millis("watermark"),
    )


class _Recorder(StreamingQueryListener):
    """One small file for each micro-batch as it ends; every ``FOLD`` of them become one file."""

    def __init__(self, spark: SparkSession, name: str, folder: str):
        self.spark, self.name, self.folder = spark, name, folder
        self.running: set[str] = set()
        self.single: dict[int, str] = {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            with self.changed:
                self.running.add(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.running.discard(str(event.runId))
            self.changed.notify_all()

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self.name:
            return
        row = dict(zip(_REPORTED.fieldNames(), _as_row(event.progress), strict=True))
        with self.changed:
            # a batch that runs again replaces its file
            files.write_text(self.spark, self._path(row["batch_id"]), json.dumps(row) + "\n")
            self.single[row["batch_id"]] = json.dumps(row)
            if len(self.single) >= FOLD:
                self.fold()

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/{batch_id:020}.json"

    def fold(self) -> None:
        """Readers see a batch twice for a moment, never not at all."""
        if len(self.single) < 2:
            return
        ids = sorted(self.single)
        lines = "".join(self.single[i] + "\n" for i in ids)
        files.write_text(self.spark, f"{self.folder}/{ids[0]:020}-{ids[-1]:020}-{uuid.uuid4().hex[:8]}.json", lines)
        for i in ids:
            files.delete(self.spark, self._path(i))
        self.single.clear()

    def finish(self, seconds: float) -> None:
        """Wait for the end of runs that have ended: Spark tells it after all of their progress."""
        with self.changed:
            active = {str(q.runId) for q in self.spark.streams.active}
            self.changed.wait_for(lambda: not self.running - active, seconds)
            self.fold()


@contextmanager
def record_progress(spark: SparkSession, name: str, folder: str, wait_seconds: float = 60) -> Iterator[None]:
    """Keep the figures of every micro-batch of the query called ``name``, in ``folder``, also when the body fails.

    Start the query inside. On leaving, what Spark still has to report of ended queries is waited for.
    """
    recorder = _Recorder(spark, name, folder)
    spark.streams.addListener(recorder)
    try:
        yield
    finally:
        recorder.finish(wait_seconds)
        spark.streams.removeListener(recorder)


def progress_log(spark: SparkSession, folder: str) -> DataFrame:
    """All micro-batches that :func:`record_progress` has kept; columns of :func:`progress_table`.

    Of a batch that ran again the later run counts.
    """
    rows = spark.read.schema(_REPORTED).json(folder)
    others = [c for c in _REPORTED.fieldNames() if c != "batch_id"]
    newest = rows.groupBy("batch_id").agg(F.max_by(F.struct(*others), "started_at").alias("kept"))
    return _timed(newest.select("batch_id", "kept.*"))


def observed_totals(progress: DataFrame) -> DataFrame:
    """What :func:`observed` counted over all micro-batches of a progress table: metric, n."""
    return progress.select(F.explode("observed").alias("metric", "n")).groupBy("metric").agg(F.sum("n").alias("n"))


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Recent micro-batches of a running query, one row each, for a look at its state.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them and forgets older
    ones; sums over a stream need :func:`record_progress`. ``max_offsets_behind`` is the
    consumer lag and is set by Kafka sources only; ``watermark_delay_ms`` is how
    far the watermark trails the newest event of the batch.
    """
    return _timed(spark.createDataFrame([_as_row(p) for p in query.recentProgress], _REPORTED))
