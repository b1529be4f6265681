"""Renderings and digests of a payload, all native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_hex(value: Column) -> Column:
    """Uppercase hex of the bytes."""
    return F.hex(value)


def payload_base64(value: Column) -> Column:
    """Base64 on one line: the built-in breaks the text every 76 characters."""
    return F.replace(F.base64(value), F.lit("\r\n"), F.lit(""))


def hex_to_base64(text: Column) -> Column:
    """Hex text to base64; ``-1`` where the text is not hex, null for null."""
    whole_bytes = F.length(text) % 2 == 0
    packed = F.when(whole_bytes, F.try_to_binary(text, F.lit("hex")))
    return F.when(text.isNotNull(), F.coalesce(payload_base64(packed), F.lit("-1")))


def payload_sha256(value: Column) -> Column:
    """Lowercase hex SHA-256 of the bytes."""
    return F.sha2(value, 256)
