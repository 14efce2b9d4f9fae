"""A log of windows beside which the events that came too late are kept, instead of vanishing."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salestream import files
from salestream.operators.aggregate import WATERMARK, WINDOW, timed, windowed_sales
from salestream.schema import SALE_COLUMNS, WINDOW_COLUMNS
from salestream.sinks.batch import ROWS_PER_FILE, write_batch
from salestream.streaming.queries import Trigger, claim, start_update


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark (milliseconds) behind which micro-batch ``batch_id`` drops rows: that of the batch before.

    It stands in the checkpoint's record of that batch, so a batch that runs again after a failure gets the same.
    """
    path = f"{checkpoint}/offsets/{batch_id - 1}"
    if batch_id == 0 or not files.exists(spark, path):
        return 0
    _, stated, *_ = files.read_text(spark, path).split("\n")
    return json.loads(stated).get("batchWatermarkMs", 0)


def start_update_log_with_late(
    events: DataFrame,
    path: str,
    late_path: str,
    checkpoint: str,
    width: str = WINDOW,
    watermark: str = WATERMARK,
    trigger: Trigger | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> StreamingQuery:
    """The log of ``windowed_sales(events, width)``, and at ``late_path`` the events that it drops.

    A row is late when its window ended at or before the watermark of the batch before. Window changes and
    events pass through one query, so both see the same micro-batches and the same watermark: served rows and late rows
    together are all rows with a time. Of the events only the late ones are kept, in the batch's one evaluation. The late
    table has the event, its window, the watermark and ``late_by_ms``, by how much the event is behind it; a batch
    that runs again replaces its own partition of both outputs. Windows do not overlap here; log panes for others.
    """
    spark = events.sparkSession
    stream = claim(spark, path, checkpoint)
    marked, start, end = timed(events.select(*SALE_COLUMNS), watermark)
    placed = marked.filter(F.col("event_time").isNotNull()).withColumn("window", F.window("event_time", width))
    event = F.struct(
        *(F.col(c) for c in ("sale_id", "amount")), F.col("event_time"), F.unix_millis("event_time").alias("at_ms"),
        F.unix_millis("window.end").alias("end_ms")).alias("event")
    raw = placed.select(
        start.alias("window_start"), end.alias("window_end"), "category", F.lit(None).cast("double").alias("revenue"),
        F.lit(None).cast("bigint").alias("sales_count"), event)
    windows = windowed_sales(events, width, watermark=watermark)
    both = windows.withColumn("event", F.lit(None).cast(raw.schema["event"].dataType)).unionByName(raw)

    def write(batch: DataFrame, batch_id: int) -> None:
        limit = late_watermark(spark, checkpoint, batch_id)
        is_window: Column = F.col("event").isNull()
        kept = batch.filter(is_window | (F.col("event.end_ms") <= limit)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(kept.filter(is_window).select(*WINDOW_COLUMNS), batch_id, path, fmt, options, rows_per_file, stream)
            late = kept.filter(~is_window).select(
                "event.sale_id", "category", "event.amount", "event.event_time", "window_start", "window_end",
                F.timestamp_millis(F.lit(limit)).alias("watermark"),
                (F.lit(limit) - F.col("event.at_ms")).alias("late_by_ms"))
            write_batch(late, batch_id, late_path, fmt, options, rows_per_file)
        finally:
            kept.unpersist()

    return start_update(both, write, checkpoint, trigger, name)


def read_late(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The late rows with the batch that dropped them; none if there has been none yet."""
    schema = ("sale_id string, category string, amount double, event_time timestamp, window_start timestamp, "
              "window_end timestamp, watermark timestamp, late_by_ms bigint, batch_id bigint")
    if not any(n.startswith("batch_id=") for n in files.children(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)
