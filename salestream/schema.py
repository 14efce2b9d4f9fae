"""Row contracts: the sale event, its JSON wire form, the windowed aggregate and
the emission log, plus adapters that bring other tables to these shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names of the JSON sale event on the wire, by our column.
WIRE_FIELDS = {
    "sale_id": "id_pedido",
    "category": "categoria",
    "amount": "valor",
    "event_time": "timestamp",
}

# Field names of a serving document, by our column.
DOCUMENT_FIELDS = {
    "window_start": "janela_inicio",
    "window_end": "janela_fim",
    "category": "categoria",
    "revenue": "faturamento_total",
    "sales_count": "volume_vendas",
}

SALE_COLUMNS = list(WIRE_FIELDS)
WINDOW_COLUMNS = list(DOCUMENT_FIELDS)

# On the wire the event time is text; parse_events turns it into a timestamp.
WIRE_TYPES = {
    "sale_id": T.StringType(),
    "category": T.StringType(),
    "amount": T.DoubleType(),
    "event_time": T.StringType(),
}

WINDOW_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("category", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("sales_count", T.LongType()),
])

# The log keeps every emission of a window; batch_id orders them.
LOG_SCHEMA = T.StructType([*WINDOW_SCHEMA.fields, T.StructField("batch_id", T.LongType())])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def wire_schema(fields: dict[str, str] = WIRE_FIELDS) -> T.StructType:
    """Explicit JSON schema of a sale event; nothing is ever inferred."""
    return T.StructType([T.StructField(fields[c], WIRE_TYPES[c]) for c in SALE_COLUMNS])


def as_sales(
    df: DataFrame, sale_id: str, category: str, amount: str, event_time: str
) -> DataFrame:
    """Name four columns of any table as a sale event.

    Types are left alone: the aggregation only asks whether ``sale_id`` is NULL,
    so a numeric id needs no cast to text for every row.
    """
    sources = (sale_id, category, amount, event_time)
    return df.select(*[F.col(src).alias(dst) for src, dst in zip(sources, SALE_COLUMNS)])


def to_documents(windows: DataFrame) -> DataFrame:
    """Rename a windowed aggregate to the field names of the serving documents."""
    return windows.select(*[F.col(c).alias(name) for c, name in DOCUMENT_FIELDS.items()])


def from_documents(documents: DataFrame) -> DataFrame:
    """Inverse of :func:`to_documents`; extra document fields are ignored."""
    return documents.select(*[F.col(name).alias(c) for c, name in DOCUMENT_FIELDS.items()])


def in_session_time(windows: DataFrame) -> DataFrame:
    """Window bounds as TIMESTAMP, for tables whose event time has no time zone."""
    return windows.withColumns({
        "window_start": F.col("window_start").cast("timestamp"),
        "window_end": F.col("window_end").cast("timestamp"),
    })


def without_zone(windows: DataFrame) -> DataFrame:
    """Window bounds as TIMESTAMP_NTZ wall-clock values of the session zone."""
    return windows.withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz"),
    })
