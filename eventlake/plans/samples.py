"""Message records, payloads and schemas derived from the supplied tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.operators import avro

# Column types of the events table, declared so that it can be streamed.
EVENTS_DDL = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string"
)

# Event types of the supplied data, as symbols of an Avro enum.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

EVENT_FIELDS = [
    {"name": "event_id", "type": "long"},
    {
        "name": "user",
        "type": {
            "type": "record",
            "name": "User",
            "fields": [
                {"name": "id", "type": "long"},
                {"name": "kind", "type": {"type": "enum", "name": "Kind", "symbols": EVENT_TYPES}},
            ],
        },
    },
    {"name": "value", "type": "double"},
    {"name": "errors", "type": ["null", "string"]},
    {"name": "tags", "type": {"type": "array", "items": "string"}},
]

ACK_AVRO = {
    "type": "record",
    "name": "Ack",
    "fields": [
        {"name": "event_id", "type": "string"},
        {"name": "errors", "type": ["null", "string"], "default": None},
    ],
}


def event_schema(name: str) -> str:
    return json.dumps({"type": "record", "name": name, "namespace": "lake", "fields": EVENT_FIELDS})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pattern lets the table be one file, which a stream does not accept by name.
    return spark.readStream.schema(EVENTS_DDL).parquet(f"{sf_dir}/event[s].parquet")


def topic() -> Column:
    """``eu-<type>.events.v1``; one user in ten is on a test topic."""
    test = F.when(F.col("user_id") % 10 == 0, "-test").otherwise("")
    return F.concat(F.lit("eu-"), "event_type", test, F.lit(".events.v1"))


def schema_number() -> Column:
    """A 24-bit schema id per event type."""
    return F.conv(F.substring(F.md5("event_type"), 1, 6), 16, 10)


def frame_header(schema_id: Column) -> Column:
    return F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id.cast("long")), 8, "0")))


def messages(events: DataFrame, value: Column, partitions: int = 4) -> DataFrame:
    """Message records from the events table.

    Offsets rise within a partition and have gaps, as in a compacted log.
    """
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        value.alias("value"),
        topic().alias("topic"),
        F.pmod("user_id", F.lit(partitions)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def nested_event() -> Column:
    """A nested event whose tags are empty for errors."""
    tags = F.when(F.col("event_type") == "error", F.array().cast("array<string>")).otherwise(
        F.array(F.col("event_type"), F.col("user_id").cast("string"))
    )
    return F.struct(
        F.col("event_id"),
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("user"),
        F.col("value"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("errors"),
        tags.alias("tags"),
    )


def json_messages(events: DataFrame) -> DataFrame:
    text = F.to_json(nested_event(), {"ignoreNullFields": "false"})
    return messages(events, F.encode(text, "utf-8"))


def avro_messages(events: DataFrame) -> DataFrame:
    """Messages framed as Avro, with a schema id per event type."""
    first = EVENT_TYPES[0]
    body = avro.encode_events(
        events.withColumn("event", nested_event()), "event", 0, event_schema(first), into="frame"
    )
    frame = F.concat(frame_header(schema_number()), F.expr("substring(frame, 6)"))
    return messages(body, frame)


def avro_schemas(events: DataFrame) -> DataFrame:
    """Schema store of the event types that occur."""
    head, tail = event_schema("\0").split(json.dumps("\0")[1:-1])
    types = events.select("event_type").distinct()
    return types.select(
        schema_number().alias("schema_id"),
        F.concat(F.lit(head), F.initcap("event_type"), F.lit(tail)).alias("body"),
    )


def ack_results(events: DataFrame) -> DataFrame:
    """Processing results in the shape acknowledgements are made from."""
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("transaction_id"),
        topic().alias("source_topic"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("errors"),
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.date_format("ts", "yyyyMMddHH").cast("long").alias("ts"),
    )


def landed_json(column: str = "events") -> Column:
    """JSON text of a landed event."""
    return F.decode(F.unbase64(column), "utf-8")
