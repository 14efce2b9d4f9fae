from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed value: a new stream starts at the end of the topic. Offsets that the broker has
# already dropped stop it, unless the caller sets failOnDataLoss to false.
KAFKA_STREAM_OPTIONS = {"startingOffsets": "latest"}
# A bounded replay covers everything the topic holds when the job starts.
KAFKA_BATCH_OPTIONS = {"startingOffsets": "earliest", "endingOffsets": "latest"}


def read_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """Unbounded scan of any streaming source.

    ``options`` go to the source as they are, so brokers, topics, credentials and
    rate limits (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``, ``minPartitions``)
    always come from the caller. File sources need ``schema`` and ``path``.
    """
    defaults = KAFKA_STREAM_OPTIONS if fmt == "kafka" else {}
    reader = spark.readStream.format(fmt).options(**{**defaults, **(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_batch(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """Bounded scan with the same contract, so a replay feeds the same transforms."""
    defaults = KAFKA_BATCH_OPTIONS if fmt == "kafka" else {}
    reader = spark.read.format(fmt).options(**{**defaults, **(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def peek(df: DataFrame, n: int = 10, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` messages for a look by eye.

    Without ``order_by`` Spark stops reading as soon as it has ``n`` rows; with
    it (say partition and offset) every task keeps its own best ``n``.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)
