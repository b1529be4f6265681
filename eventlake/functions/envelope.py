"""Frame header and provenance columns of a landed row.

All of it is native Spark expressions, so the whole envelope stays inside one
code-generated projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frame layout is one magic byte (0), a 4-byte big-endian schema
# id, then the body.
HEADER_BYTES = 5
MAGIC = "0"

# Fixed values: (text the topic contains, counterparty it stands for).
COUNTERPARTY_RULES = (("test", "core"),)

# Columns that carry the processing time.
TIME_PARTITIONS = ("year", "month", "ts")

# Source column -> landed column.
METADATA_NAMES = {
    "topic": "kafka_metadata_topic",
    "offset": "kafka_metadata_offset",
    "partition": "kafka_metadata_partition",
}


def schema_id(value: Column) -> Column:
    """Decimal text of bytes 1-4; null when the frame is too short to hold them."""
    return F.when(
        F.octet_length(value) >= HEADER_BYTES,
        F.conv(F.hex(F.substring(value, 2, 4)), 16, 10),
    )


def magic_byte(value: Column) -> Column:
    """Decimal text of byte 0; null for an empty or null frame."""
    return F.conv(F.hex(F.substring(value, 1, 1)), 16, 10)


def counterparty(
    topic: Column, rules: Sequence[tuple[str, str]] = COUNTERPARTY_RULES
) -> Column:
    """Name of the first rule whose text occurs in the topic, else null."""
    matches = [F.when(topic.contains(text), F.lit(name)) for text, name in rules]
    return F.coalesce(*matches, F.lit(None).cast("string"))


def time_partitions(as_of: Column) -> dict[str, Column]:
    """``year`` int, ``month`` two-digit text and ``ts`` int ``yyyyMMddHH``."""
    return {
        "year": F.year(as_of),
        "month": F.date_format(as_of, "MM"),
        "ts": F.date_format(as_of, "yyyyMMddHH").cast("int"),
    }


def add_header(df: DataFrame) -> DataFrame:
    """Schema id and magic byte of the binary frame in ``value``."""
    return df.withColumns(
        {
            "kafka_metadata_schemaid": schema_id(F.col("value")),
            "kafka_magic_byte": magic_byte(F.col("value")),
        }
    )


def add_envelope(
    df: DataFrame,
    as_of: Column | str | None = None,
    rules: Sequence[tuple[str, str]] = COUNTERPARTY_RULES,
) -> DataFrame:
    """Provenance columns shared by every payload kind.

    ``as_of`` is the time the partition columns come from: processing time by
    default, an event-time column for replays that must land deterministically.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    elif isinstance(as_of, str):
        as_of = F.col(as_of)
    return df.withColumns(
        {
            "counterparty": counterparty(F.col("topic"), rules),
            "kafka_metadata_kafka_ingested_timestamp": F.unix_timestamp("timestamp"),
            "key": F.col("key").cast("string"),
            **time_partitions(as_of),
        }
    ).withColumnsRenamed(METADATA_NAMES)
