"""Events and alerts as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EXTRA_TYPE, META_KEYS, metadata_map, micros
from .clock import rfc3339_text

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("Timestamp", T.StringType()),
        T.StructField("EventType", T.StringType()),
        T.StructField("Source", T.StringType()),
        T.StructField("Metadata", EXTRA_TYPE),
    ]
)

# Characters written as escapes so that a document is safe inside HTML.
HTML_ESCAPES = (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), (" ", "\\u2028"), (" ", "\\u2029"))


def event_json(keys: tuple[str, ...] = META_KEYS) -> Column:
    """One event as the JSON document the store keeps."""
    doc = F.to_json(
        F.struct(
            rfc3339_text(micros()).alias("Timestamp"),
            F.coalesce("event_type", F.lit("")).alias("EventType"),
            F.coalesce("source", F.lit("")).alias("Source"),
            metadata_map(keys).alias("Metadata"),
        )
    )
    for raw, escaped in HTML_ESCAPES:
        doc = F.replace(doc, F.lit(raw), F.lit(escaped))
    return doc


def event_from_json(text: Column) -> Column:
    """The struct (Timestamp, EventType, Source, Metadata) of a document."""
    return F.from_json(text, DOCUMENT_SCHEMA)
