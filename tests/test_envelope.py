import base64
import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from eventlake import digest, envelope

MESSAGE_DDL = (
    "key binary, value binary, topic string, partition int, offset long, "
    "timestamp timestamp, timestampType int"
)


@pytest.mark.parametrize(
    "frame, schema_id, magic",
    [
        (b"\0\0\0\0\7body", "7", "0"),
        (b"\0\xff\xff\xff\xffbody", "4294967295", "0"),
        (b"\0\0\0\0\7", "7", "0"),
        (b"\1\0\0\1\0x", "256", "1"),
        (b"\0\1", None, "0"),
        (b"", None, None),
        (None, None, None),
    ],
)
def test_header(spark, frame, schema_id, magic):
    row = envelope.add_header(spark.createDataFrame([(frame,)], "value binary")).first()
    assert (row.kafka_metadata_schemaid, row.kafka_magic_byte) == (schema_id, magic)


def test_counterparty_takes_the_first_rule_and_keeps_null(spark):
    rules = (("test", "core"), ("eu", "europe"))
    topics = spark.createDataFrame([("eu-test",), ("eu-live",), ("us",), (None,)], "t string")
    names = topics.select(envelope.counterparty(F.col("t"), rules).alias("c"))
    assert [row.c for row in names.collect()] == ["core", "europe", None, None]


def test_envelope_columns(spark):
    at = dt.datetime(2024, 3, 7, 5, 59, 59, 900_000)
    rows = [(b"k", b"v", "eu-test.events.v1", 3, 42, at, 0), (None, None, None, 0, 0, at, 0)]
    landed = envelope.add_envelope(spark.createDataFrame(rows, MESSAGE_DDL), "timestamp")
    first, second = landed.collect()
    assert first.key == "k"
    assert first.kafka_metadata_topic == "eu-test.events.v1"
    assert (first.kafka_metadata_partition, first.kafka_metadata_offset) == (3, 42)
    assert first.kafka_metadata_kafka_ingested_timestamp == int(
        at.replace(tzinfo=dt.timezone.utc).timestamp()
    )
    assert (first.year, first.month, first.ts) == (2024, "03", 2024030705)
    assert first.timestampType == 0
    assert (second.key, second.counterparty) == (None, None)


def test_processing_time_is_the_default(spark):
    row = envelope.add_envelope(
        spark.createDataFrame([(b"", b"", "t", 0, 0, dt.datetime(2001, 1, 1), 0)], MESSAGE_DDL)
    ).first()
    assert row.year >= 2024


def test_digests_of_a_long_payload(spark):
    raw = bytes(range(256)) * 3
    row = (
        spark.createDataFrame([(raw,)], "v binary")
        .select(
            digest.payload_base64(F.col("v")).alias("b64"),
            digest.payload_hex(F.col("v")).alias("hex"),
            digest.payload_sha256(F.col("v")).alias("sha"),
        )
        .first()
    )
    assert row.b64 == base64.b64encode(raw).decode()
    assert row.hex == raw.hex().upper()
    assert row.sha == hashlib.sha256(raw).hexdigest()


@pytest.mark.parametrize(
    "text, expected",
    [("00FF", "AP8="), ("", ""), ("0", "-1"), ("zz", "-1"), (None, None), ("0f" * 90, None)],
)
def test_hex_to_base64(spark, text, expected):
    if text and len(text) > 100:
        expected = base64.b64encode(bytes.fromhex(text)).decode()
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(digest.hex_to_base64(F.col("t")).alias("b")).first().b == expected
