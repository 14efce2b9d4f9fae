from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestream.operators import manifest
from salestream.schema import DOCUMENT_FIELDS, WINDOW_SCHEMA, from_documents, in_session_time, to_documents

ROWS_PER_FILE = 1_000_000
#: A smaller change of a revenue is the rounding of sums.
LEAST_DELTA = 1e-6


def write_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    stream: str | None = None,
) -> int:
    """Store one micro-batch in the emission log and return its number of rows.

    A log with a manifest takes the batch up once it is written; with ``stream``, only if it is that stream's.

    The batch replaces its own ``batch_id`` partition, so a batch that Spark runs
    again after a failure leaves the log as it was. An empty batch writes nothing.

    The rows are counted and written from one cached evaluation: a second one
    would run the stateful plan again. The count also sizes the files; merging
    cached partitions costs no shuffle, and a log with one small file per state
    partition and batch would soon be slow to list.
    """
    spark, batch = batch.sparkSession, batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows = batch.count()
        if n_rows:
            (
                batch.coalesce(-(-n_rows // rows_per_file))
                .sortWithinPartitions("window_start", "category")
                .withColumn("batch_id", F.lit(batch_id).cast("long"))
                .write.format(fmt)
                .options(**(options or {}))
                .partitionBy("batch_id")
                .option("partitionOverwriteMode", "dynamic")
                .mode("overwrite")
                .save(path)
            )
            manifest.add_batch(spark, path, batch_id, stream)
        return n_rows
    finally:
        batch.unpersist()


def write_windows(windows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a windowed table in time order, so that looking up a window skips row groups.

    Bounds are stored as TIMESTAMP in microseconds, which have statistics; Spark's default
    form has none. ``path`` is replaced.
    """
    conf, key = windows.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(key)
    conf.set(key, "TIMESTAMP_MICROS")
    try:
        in_session_time(windows).orderBy("window_start", "category").write.format(fmt).mode(
            "overwrite").save(path)
    finally:
        conf.set(key, before)


def append_documents(
    batch: DataFrame, batch_id: int, fmt: str, options: Mapping[str, str]
) -> int:
    """Append one micro-batch to a document store and return its number of rows.

    ``fmt`` and ``options`` name the connector, its address, database and
    collection. A repeated batch is appended again; use :func:`write_batch` and
    ``serving.latest`` where figures must be exact.
    """
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows = batch.count()
        if n_rows:
            to_documents(batch).write.format(fmt).options(**options).mode("append").save()
        return n_rows
    finally:
        batch.unpersist()


def append_deltas(batch: DataFrame, fmt: str, options: Mapping[str, str]) -> int:
    """Append what the windows of a micro-batch have over what the document store holds; returns its number of rows.

    ``batch`` has whole figures of windows. The store's documents of the same time range are summed by window and subtracted, so
    all documents of a window sum to its newest figures, although nothing in the store is ever replaced. A batch that
    runs again, or whose first run stopped halfway, appends only what is still missing. The store must show its own
    appends to the next read, and have one writer. A window without revenue has the sum 0 here.
    """
    spark, batch = batch.sparkSession, batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # the time range of the batch reaches the scan of the store; a batch changes few windows of a long history
        low, high = batch.agg(F.min("window_start"), F.max("window_start")).first()
        if low is None:
            return 0
        keys = ("window_start", "window_end", "category")
        figures = ("revenue", "sales_count")
        new = batch.select(*keys, *figures)
        try:
            fields = T.StructType([T.StructField(DOCUMENT_FIELDS[f.name], f.dataType) for f in WINDOW_SCHEMA])
            held = from_documents(spark.read.format(fmt).options(**options).schema(fields).load())
            old = held.filter(F.col("window_start").between(low, high)).select(*keys, *(-F.col(c) for c in figures))
            old = old.join(batch.select(*keys), _same(keys, batch, old), "left_semi")
            new = new.union(old)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        deltas = new.groupBy(*keys).agg(
            F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"), F.sum("sales_count").alias("sales_count"))
        # what is left of two equal sums of doubles is no change
        deltas = deltas.filter((F.abs("revenue") >= LEAST_DELTA) | (F.col("sales_count") != 0))
        deltas = deltas.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n_rows = deltas.count()
            if n_rows:
                to_documents(deltas).write.format(fmt).options(**options).mode("append").save()
            return n_rows
        finally:
            deltas.unpersist()
    finally:
        batch.unpersist()


def _same(keys: tuple[str, ...], one: DataFrame, two: DataFrame) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & one[key].eqNullSafe(two[key])
    return same
