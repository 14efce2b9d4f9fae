"""The emission log of windowed sales and the current table derived from it.

In update mode a stream emits a window again whenever it changes. The log keeps
all emissions, partitioned by micro-batch; ``latest`` keeps the newest of each
window and category, which is the upsert a plain append cannot give.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from salestream import files
from salestream.operators import manifest
from salestream.operators.manifest import Manifest
from salestream.schema import LOG_SCHEMA, WINDOW_SCHEMA

_GENERATION = "generation-"


def _stored(
    spark: SparkSession, path: str, fmt: str, schema: StructType, missing_ok: bool
) -> DataFrame:
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_log(
    spark: SparkSession, path: str, fmt: str = "parquet", missing_ok: bool = False
) -> DataFrame:
    """All emissions. A path that does not exist is an error, or an empty log if
    ``missing_ok``: a stream's log is there only once its first batch has been written.

    The schema is given, since inference would read the partition value
    ``batch_id`` as an int and fail on an empty log.
    """
    return _stored(spark, path, fmt, LOG_SCHEMA, missing_ok)


def read_windows(
    spark: SparkSession, path: str, fmt: str = "parquet", missing_ok: bool = False
) -> DataFrame:
    """Final windows of a stream, or the output of a batch run."""
    return _stored(spark, path, fmt, WINDOW_SCHEMA, missing_ok)


def latest(log: DataFrame, version: str = "batch_id") -> DataFrame:
    """Newest emission of every (window_start, category).

    One ``max_by`` per column keeps fixed-width buffers, so this is a hash
    aggregate that combines before the shuffle: a window emitted in thousands of
    batches costs its reducer one row per map task.
    """
    newest = [
        F.max_by(c, version).alias(c) for c in ("window_end", "revenue", "sales_count")
    ]
    return (
        log.groupBy("window_start", "category")
        .agg(*newest)
        .select("window_start", "window_end", "category", "revenue", "sales_count")
    )


def _newest(log: DataFrame) -> DataFrame:
    """:func:`latest`, with the batch that emitted the row."""
    newest = [F.max_by(c, "batch_id").alias(c) for c in ("window_end", "revenue", "sales_count")]
    return log.groupBy("window_start", "category").agg(
        *newest, F.max("batch_id").alias("batch_id")).select(LOG_SCHEMA.fieldNames())


def _live(spark: SparkSession, log_path: str, fmt: str, found: Manifest) -> DataFrame:
    """The rows of the batches that are live in ``found``; other folders are not opened."""
    if not found.batches:
        return spark.createDataFrame([], LOG_SCHEMA)
    live = F.lit(False)
    for first, last in found.batches:
        live = live | F.col("batch_id").between(first, last)
    return read_log(spark, log_path, fmt).filter(live)


def _folded(spark: SparkSession, fmt: str, found: Manifest, days: list[str] | None = None) -> DataFrame:
    """The rows of the compacted table, or of some of its days."""
    wanted = sorted(found.days if days is None else found.days.keys() & set(days))
    if not wanted:
        return spark.createDataFrame([], LOG_SCHEMA)
    paths = [f"{found.table}/{found.days[day]}/day={day}" for day in wanted]
    return spark.read.format(fmt).schema(LOG_SCHEMA).load(paths)


def read_current(
    spark: SparkSession, log_path: str, table_path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The current table from the compacted days and the batches after them, with batch ids.

    Equal to ``latest(read_log(...))`` of a log that was never compacted. What belongs to it is read from the manifest
    once, so a compaction that runs meanwhile is seen whole or not at all. ``table_path`` need not be stated; if it
    is, it must be where the manifest says.
    """
    found = manifest.read(spark, log_path)
    if found is None:
        return _newest(read_log(spark, log_path, fmt))
    if table_path and found.table and table_path != found.table:
        raise ValueError(f"the log {log_path} is compacted to {found.table}, not {table_path}")
    return _newest(_folded(spark, fmt, found).unionByName(_live(spark, log_path, fmt, found)))


def _day() -> Column:
    return F.date_format("window_start", "yyyy-MM-dd")


def compact(
    spark: SparkSession, log_path: str, table_path: str, fmt: str = "parquet"
) -> int | None:
    """Fold the live batches of the log into the compacted table; returns the last one folded.

    The table is kept by day of the window (session zone). Only days that the batches touch are written again, into a
    new generation of their own; all other files stay as they are. Nothing that is being read is replaced: the new
    generation counts once the manifest names it. An interrupted compaction leaves files that no manifest names, which
    ``drop_folded`` deletes. A stream may write meanwhile; the batches it adds stay live. Of two compactions
    at once the second to finish fails and changes nothing.
    """
    found = manifest.read(spark, log_path) or manifest.listed(spark, log_path)
    last = found.last
    if last is None:
        return found.folded
    live = _live(spark, log_path, fmt, found)
    touched = live.agg(F.collect_set(_day())).first()[0]  # as many as days
    rows = _newest(_folded(spark, fmt, found, touched).unionByName(live))
    generation = f"{_GENERATION}{last:012}-{uuid.uuid4().hex[:8]}"
    # a day's rows meet in few tasks, so a day has few files; sorting lets a lookup skip row groups
    dealt = rows.withColumn("day", _day()).repartitionByRange("window_start", "category")
    (
        dealt.sortWithinPartitions("day", "window_start", "category").write.format(fmt).partitionBy("day")
        .option("partitionOverwriteMode", "static").mode("overwrite").save(f"{table_path}/{generation}")
    )

    def step(now: Manifest) -> Manifest:
        if (now.stream, now.folded, now.table, now.days) != (found.stream, found.folded, found.table, found.days):
            raise RuntimeError(f"{log_path} was compacted or emptied by another run meanwhile")
        days = {**now.days, **dict.fromkeys(touched, generation)}
        return replace(now, folded=last, table=table_path, days=days, batches=now.without(last))

    manifest.change(spark, log_path, step)
    return last


def drop_folded(spark: SparkSession, log_path: str, table_path: str | None = None) -> None:
    """Delete what the manifest no longer names: folded batches, days that a later generation holds, leftovers.

    Run it when no reader still uses them and no compaction runs.
    """
    found = manifest.read(spark, log_path)
    if found is None:
        return
    for name in files.children(spark, log_path):
        if name.startswith("batch_id=") and found.folded is not None:
            if int(name.removeprefix("batch_id=")) <= found.folded:
                files.delete(spark, f"{log_path}/{name}")
    table_path = found.table or table_path
    generations = files.children(spark, table_path) if table_path else []
    for generation in (g for g in generations if g.startswith(_GENERATION)):
        named = {f"day={day}" for day, of in found.days.items() if of == generation}
        if not named:
            files.delete(spark, f"{table_path}/{generation}")
            continue
        for name in files.children(spark, f"{table_path}/{generation}"):
            if name.startswith("day=") and name not in named:
                files.delete(spark, f"{table_path}/{generation}/{name}")


def truncate(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """Remove all rows of the log at ``path`` and forget its stream and its compacted table.

    Batch ids start again at 0 with a new checkpoint. The checkpoint of the stream so far is refused from now on, and a running
    one fails at its next batch; a new one may start. Files of the compacted table are no longer read.
    """
    if not path:
        raise ValueError("truncate needs the path of the log")
    manifest.change(spark, path, lambda found: Manifest(version=found.version), create=True)
    (
        spark.createDataFrame([], LOG_SCHEMA)
        .write.format(fmt)
        .partitionBy("batch_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("append")
        .save(path)
    )
    for name in files.children(spark, path):
        if name.startswith("batch_id="):
            files.delete(spark, f"{path}/{name}")
