from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salestream.functions import iso_time
from salestream.schema import WIRE_FIELDS

# Delivery and batching settings of the event producer.
KAFKA_SINK_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "10",
    "kafka.batch.size": "16384",
}


def to_envelope(
    sales: DataFrame, fields: Mapping[str, str] = WIRE_FIELDS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Sale events as JSON messages in a binary column ``value``.

    ``keep`` carries further input columns along, such as ``topic`` or ``key``.
    """
    body = F.struct(
        F.col("sale_id").cast("string").alias(fields["sale_id"]),
        F.col("category").alias(fields["category"]),
        F.col("amount").alias(fields["amount"]),
        iso_time(F.col("event_time")).alias(fields["event_time"]),
    )
    message = F.to_json(body, {"ignoreNullFields": "false"}).cast("binary")
    return sales.select(*keep, message.alias("value"))


def publish(
    envelope: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery | None:
    """Send messages to a topic, from a table (returns when done) or a stream."""
    defaults = KAFKA_SINK_OPTIONS if fmt == "kafka" else {}
    settings = {**defaults, **options}
    if not envelope.isStreaming:
        envelope.write.format(fmt).options(**settings).mode("append").save()
        return None
    if not checkpoint:
        raise ValueError("publishing a stream needs a checkpoint path")
    writer = envelope.writeStream.format(fmt).options(**settings)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()
