"""From message records to landed rows, one function per payload kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import digest, envelope, payload
from eventlake.operators import avro, registry

BAD_JSON = "bad_json"


def _enveloped(df: DataFrame, as_of: Column | str | None, arrange: Sequence[str] | None) -> DataFrame:
    """Envelope columns, and rows of one landing partition brought together.

    The shuffle, if any, happens here: undecoded messages are several times
    smaller than landed rows, and evenly sized tasks even out the decoding.
    """
    enveloped = envelope.add_envelope(df, as_of)
    return enveloped if arrange is None else enveloped.hint("rebalance", *arrange)


def decode_avro(
    df: DataFrame,
    schemas: DataFrame | registry.SchemaTable,
    drop: Sequence[str] = (),
    as_of: Column | str | None = None,
    arrange: Sequence[str] | None = None,
) -> DataFrame:
    """Framed Avro messages to landed rows.

    Works on bounded and streaming input. On a stream the schemas are those of
    the moment it starts; inside a micro-batch they are those of the batch.
    """
    framed = envelope.add_header(_enveloped(df, as_of, arrange))
    raw = F.col("value")
    return avro.decode_events(framed, schemas, drop).withColumns(
        {
            "kafka_metadata_hashed_payload": digest.payload_base64(raw),
            "payload_sha256": digest.payload_sha256(raw),
            "value": digest.payload_hex(raw),
        }
    )


def decode_json(
    df: DataFrame,
    schemas: DataFrame | None = None,
    drop: Sequence[str] = (),
    as_of: Column | str | None = None,
    arrange: Sequence[str] | None = None,
) -> DataFrame:
    """JSON messages to landed rows; ``schemas`` is not used.

    A payload that is not a JSON object keeps its bytes in ``value``, has null
    ``events`` and is marked in ``decode_error``.
    """
    flat, raw = F.col("flat"), F.col("value")
    landed = F.coalesce(flat, raw)
    flattened = _enveloped(df, as_of, arrange).withColumn("flat", payload.flatten_text(raw, drop))
    return flattened.withColumns(
        {
            "kafka_metadata_schemaid": F.lit("json"),
            "kafka_magic_byte": F.lit("json"),
            "kafka_metadata_hashed_payload": digest.payload_sha256(landed),
            "payload_sha256": digest.payload_sha256(raw),
            "events": digest.payload_base64(flat),
            "decode_error": F.when(flat.isNull() & raw.isNotNull(), F.lit(BAD_JSON)),
            "value": landed,
        }
    ).drop("flat")


def decode_avro_dropping(
    df: DataFrame,
    schemas: DataFrame | registry.SchemaTable,
    drop: Sequence[str] = (),
    as_of: Column | str | None = None,
    arrange: Sequence[str] | None = None,
) -> DataFrame:
    """Framed Avro messages without some of their keys."""
    if not drop:
        raise ValueError("avro_drop_select_keys needs the keys to drop")
    return decode_avro(df, schemas, drop, as_of, arrange)


# Event types and their transformations.
TRANSFORMS = {
    "avro": decode_avro,
    "json": decode_json,
    "avro_drop_select_keys": decode_avro_dropping,
}
