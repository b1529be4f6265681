"""Acknowledgement messages from processing results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.avro import encode_events

# Declared schema of the result files.
RESULT_DDL = (
    "event_id string, transaction_id string, source_topic string, errors string, "
    "year int, month int, ts long"
)

# Payload field -> column it comes from.
ACK_FIELDS = {"event_id": "event_id", "errors": "errors"}


def ack_payload(fields: Mapping[str, str] = ACK_FIELDS) -> Column:
    """Payload as a struct, so that each field keeps its type."""
    return F.struct(*(F.col(column).alias(name) for name, column in fields.items()))


def ack_payload_map(fields: Mapping[str, str] = ACK_FIELDS) -> Column:
    """Payload as a string map, for consumers of the untyped form."""
    return F.create_map(
        *(part for name, column in fields.items() for part in (F.lit(name), F.col(column)))
    )


def reply_topic(topic: Column) -> Column:
    """The source topic without any ``events`` in it."""
    return F.regexp_replace(topic, "events", "")


def build_acks(
    df: DataFrame,
    schema_id: int,
    schema: str | dict,
    fields: Mapping[str, str] = ACK_FIELDS,
    error: str | None = None,
) -> DataFrame:
    """Add ``mapped_ack``, ``key``, ``topic`` and the framed Avro ``value``.

    ``error`` names a column that says why a result has no frame; without it such a
    result fails the job.
    """
    named = df.withColumns(
        {
            "mapped_ack": ack_payload(fields),
            "key": F.col("transaction_id"),
            "topic": reply_topic(F.col("source_topic")),
        }
    )
    return encode_events(named, "mapped_ack", schema_id, schema, error=error)
