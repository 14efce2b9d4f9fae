"""From broker messages to typed sale events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestream.schema import SALE_COLUMNS, WIRE_FIELDS, wire_schema


def decode(envelope: DataFrame) -> DataFrame:
    """The message body as text, in one column ``json_value``."""
    return envelope.select(F.col("value").cast("string").alias("json_value"))


def parse_events(
    envelope: DataFrame, fields: Mapping[str, str] = WIRE_FIELDS, keep_raw: bool = False
) -> DataFrame:
    """Sale events from messages with a binary or text column ``value``.

    Text that is no JSON object, missing fields and fields of the wrong type give
    NULLs, an unreadable time gives a NULL ``event_time``; nothing raises, because
    one bad message must not stop a stream. ``keep_raw`` adds the body as ``raw``.

    The struct is unfolded by a generator rather than by ``select("data.*")``: the
    NULL filter that ``window`` adds on the event time would otherwise be pushed
    below the projection and parse each message a second time.
    """
    data = F.from_json("json_value", wire_schema(dict(fields)))
    parsed = decode(envelope).select(
        *([F.col("json_value").alias("raw")] if keep_raw else []), F.inline(F.array(data))
    )
    typed = {c: F.col(f"`{fields[c]}`") for c in SALE_COLUMNS}
    typed["event_time"] = F.try_to_timestamp(typed["event_time"])
    return parsed.select(
        *[col.alias(c) for c, col in typed.items()], *(["raw"] if keep_raw else [])
    )


def missing_field(required: Sequence[str] = SALE_COLUMNS) -> Column:
    """Name of the first required column that is NULL, or NULL when all are set."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])


def classified(events: DataFrame, required: Sequence[str] = SALE_COLUMNS) -> DataFrame:
    """All events, with their ``reject_reason`` or NULL."""
    return events.withColumn("reject_reason", missing_field(required))


def split_valid_invalid(
    events: DataFrame, required: Sequence[str] = ("event_time",)
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) events; rejected ones carry a ``reject_reason``.

    By default only events without a time are rejected, which are exactly those
    the windowed aggregation drops. Pass ``SALE_COLUMNS`` for the strict contract.
    Writing both sides reads the input twice; to do it in one pass, write
    :func:`classified` events and derive both from that table.
    """
    reason = missing_field(required)
    valid = events.filter(reason.isNull())
    rejected = events.withColumn("reject_reason", reason).filter(
        F.col("reject_reason").isNotNull()
    )
    return valid, rejected
