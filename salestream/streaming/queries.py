from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from salestream import files
from salestream.operators import manifest
from salestream.operators.parse import split_valid_invalid
from salestream.schema import SALE_COLUMNS
from salestream.sinks.batch import ROWS_PER_FILE, append_deltas, append_documents, write_batch

# State on local disk with incremental snapshots to the checkpoint, instead of
# on the executor heap: the number of open windows is then not bounded by memory.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

Trigger = Mapping[str, object]


#: Written into an output when its stream first starts; readers skip the name.
_OWNED = "_owned-by-a-stream"


def use_state_store(spark: SparkSession) -> None:
    """State of streams started from now on goes to RocksDB (a checkpoint keeps its own)."""
    for key, value in STATE_STORE_CONF.items():
        spark.conf.set(key, value)


#: Kept in the checkpoint.
_STREAM_ID = "salestream-id"
_TOGETHER = "; reset both together, see serving.truncate"


def _guard(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse an output and a checkpoint that are not of one stream.

    Batch ids start again with a new checkpoint: on an old output they would replace, or be
    taken for, batches that are there already.
    """
    begun = bool(files.children(spark, f"{checkpoint}/offsets"))
    names = files.children(spark, path)
    filled = [n for n in names if not n.startswith(("_", "."))] or "_spark_metadata" in names
    if filled and not begun:
        raise ValueError(f"{path} holds batches, but the checkpoint {checkpoint} is new{_TOGETHER}")
    if begun and _OWNED not in names:
        raise ValueError(f"the checkpoint {checkpoint} has begun, but {path} is not its output{_TOGETHER}")
    if _OWNED not in names:
        files.write_text(spark, f"{path}/{_OWNED}", "")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint keeps; a checkpoint without one gets one."""
    path = f"{checkpoint}/{_STREAM_ID}"
    if not files.exists(spark, path):
        files.write_new(spark, path, uuid.uuid4().hex)
    return files.read_text(spark, path)


def claim(spark: SparkSession, path: str, checkpoint: str) -> str:
    """The id of the stream of ``checkpoint``, entered as the writer of the log at ``path``.

    The manifest outlives the batches: a log whose batches are all folded and deleted still names its stream.
    """
    begun = bool(files.children(spark, f"{checkpoint}/offsets"))
    found = manifest.read(spark, path)
    stream = stream_id(spark, checkpoint)
    if begun and (found is None or found.stream != stream):
        raise ValueError(f"the checkpoint {checkpoint} has begun, but {path} is not its output{_TOGETHER}")
    try:
        manifest.own(spark, path, stream)
    except manifest.ForeignLog as error:
        raise ValueError(f"{path} holds batches, but the checkpoint {checkpoint} is new{_TOGETHER}") from error
    return stream


def _start(
    writer: DataStreamWriter, checkpoint: str, trigger: Trigger | None, name: str | None
) -> StreamingQuery:
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).start()


def _start_append(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger | None,
    name: str | None,
    fmt: str,
    options: Mapping[str, str] | None,
) -> StreamingQuery:
    writer = (
        rows.writeStream.outputMode("append")
        .format(fmt)
        .options(**(options or {}))
        .option("path", path)
    )
    return _start(writer, checkpoint, trigger, name)


def start_update(
    windows: DataFrame,
    write: Callable[[DataFrame, int], object],
    checkpoint: str,
    trigger: Trigger | None,
    name: str | None,
) -> StreamingQuery:
    """A query in update mode whose micro-batches go to ``write``."""
    writer = windows.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, checkpoint, trigger, name)


def start_update_log(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> StreamingQuery:
    """Write every change of a window to the emission log, at once and idempotently.

    ``trigger`` holds the keywords of ``DataStreamWriter.trigger``; the default is
    back-to-back micro-batches. ``path`` and ``checkpoint`` belong together: a new
    checkpoint on a log with batches, or the reverse, is an error.
    """
    stream = claim(windows.sparkSession, path, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, fmt, options, rows_per_file, stream)

    return start_update(windows, write, checkpoint, trigger, name)


def start_document_append(
    windows: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Trigger | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append every change of a window to a document store.

    At-least-once, and each change is one more document: summing the collection
    over-counts. This is the plain live sink; prefer :func:`start_update_log`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_documents(batch, batch_id, fmt, options)

    return start_update(windows, write, checkpoint, trigger, name)


def start_delta_append(
    windows: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Trigger | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a document store what each change of a window adds to what the store holds already.

    The documents of a window then sum to its figures, in a plain append-only collection, also when a batch
    runs again; see :func:`salestream.sinks.append_deltas`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_deltas(batch, fmt, options)

    return start_update(windows, write, checkpoint, trigger, name)


def start_final_windows(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Write each window once, when the watermark has passed its end.

    The file sink's own commit log makes this exactly-once; figures appear later
    than with :func:`start_update_log` and need no deduplication. A new checkpoint on
    windows that are there already, or the reverse, is an error.
    """
    _guard(windows.sparkSession, path, checkpoint)
    return _start_append(windows, path, checkpoint, trigger, name, fmt, options)


def start_rejects(
    events: DataFrame,
    path: str,
    checkpoint: str,
    required: Sequence[str] = SALE_COLUMNS,
    trigger: Trigger | None = None,
    name: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Write events that lack a required field, with the reason, to a table.

    Parse with ``keep_raw=True`` to keep the messages themselves. This is a query
    of its own with its own checkpoint and does not hold up the aggregation. A new checkpoint on
    rejects that are there already, or the reverse, is an error.
    """
    _guard(events.sparkSession, path, checkpoint)
    _, rejected = split_valid_invalid(events, required)
    return _start_append(rejected, path, checkpoint, trigger, name, fmt, options)
