"""Reading messages: continuously, by offset range, or from files.

The transport is a format name handed to Spark ("kafka" needs its connector on
the class path). Any format whose rows have the message columns works the same.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns of a message record, as the Kafka connector declares them.
MESSAGE_DDL = (
    "key binary, value binary, topic string, partition int, offset long, "
    "timestamp timestamp, timestampType int"
)

# What an offset of -1 or -2 means to the connector.
LATEST, EARLIEST = -1, -2

# More ranges than this are joined as a small table instead of being spelled
# out in the filter.
MAX_RANGE_TERMS = 16

# A range table of at most this many rows is small enough to broadcast.
MAX_BROADCAST_RANGES = 100_000

# topic -> partition -> (first offset, offset after the last)
Ranges = Mapping[str, Mapping[int, tuple[int, int]]]


def kafka_options(
    servers: Sequence[str],
    topics: Sequence[str] = (),
    client: Mapping[str, str] | None = None,
    **connector: object,
) -> dict[str, str]:
    """Options of the Kafka format.

    ``client`` holds settings of the Kafka client itself and gets the
    ``kafka.`` prefix; ``connector`` holds settings of the Spark connector.
    """

    def text(value: object) -> str:
        return str(value).lower() if isinstance(value, bool) else str(value)

    options = {"kafka.bootstrap.servers": ",".join(servers)}
    if topics:
        options["subscribe"] = ",".join(topics)
    for name, value in (client or {}).items():
        options[name if name.startswith("kafka.") else f"kafka.{name}"] = text(value)
    return options | {name: text(value) for name, value in connector.items()}


def event_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
    topics: Sequence[str] = (),
) -> DataFrame:
    """Continuous read of a message source.

    ``topics`` narrows the stream: at the source for Kafka, as a pushed-down
    filter elsewhere.
    """
    options = dict(options or {})
    if topics and fmt == "kafka":
        options["subscribe"] = ",".join(topics)
    source = spark.readStream.format(fmt).options(**options)
    stream = (source if schema is None else source.schema(schema)).load()
    if topics and fmt != "kafka":
        stream = stream.filter(F.col("topic").isin(*topics))
    return stream


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None
) -> DataFrame:
    """Stream of Parquet files with a declared schema."""
    source = spark.readStream.schema(schema)
    if max_files is not None:
        source = source.option("maxFilesPerTrigger", max_files)
    return source.parquet(path)


# How a Kafka read can be told its topics; one of them may be given.
SUBSCRIPTIONS = ("subscribe", "subscribePattern", "assign")


def _check_ranges(ranges: Ranges) -> None:
    for topic, parts in ranges.items():
        for partition, (start, stop) in parts.items():
            if start < EARLIEST or start == LATEST or stop < LATEST:
                raise ValueError(f"not a range: {topic} {partition} from {start} to {stop}")


def offsets_json(ranges: Ranges, end: bool) -> str:
    """``startingOffsets`` or ``endingOffsets`` of the Kafka connector."""
    _check_ranges(ranges)
    return json.dumps(
        {
            topic: {str(partition): bounds[int(end)] for partition, bounds in parts.items()}
            for topic, parts in ranges.items()
        }
    )


def _flat(ranges: Ranges) -> list[tuple[str, int, int, int | None]]:
    return [
        (topic, partition, max(start, 0), None if stop == LATEST else stop)
        for topic, parts in ranges.items()
        for partition, (start, stop) in parts.items()
    ]


def _within(start: Column | int, stop: Column | int | None) -> Column:
    offset = F.col("offset")
    return (offset >= start) if stop is None else (offset >= start) & (offset < stop)


def in_ranges(df: DataFrame, ranges: Ranges) -> DataFrame:
    """Rows of a message table inside the ranges; start inclusive, end exclusive."""
    _check_ranges(ranges)
    flat = _flat(ranges)
    if not flat:
        return df.filter(F.lit(False))
    if len(flat) <= MAX_RANGE_TERMS:
        terms = [
            (F.col("topic") == topic) & (F.col("partition") == part) & _within(start, stop)
            for topic, part, start, stop in flat
        ]
        return df.filter(reduce(or_, terms))
    # The range table has exactly the entries the caller passed in, so its size
    # is known here. The coarse bounds still reach the scan.
    spark = df.sparkSession
    table = spark.createDataFrame(flat, "topic string, partition int, start long, stop long")
    if len(flat) <= MAX_BROADCAST_RANGES:
        table = F.broadcast(table)
    stops = [stop for *_, stop in flat]
    coarse = _within(
        min(start for _, _, start, _ in flat), None if None in stops else max(stops)
    ) & F.col("topic").isin(*ranges)
    inside = (F.col("offset") >= F.col("start")) & (
        F.col("stop").isNull() | (F.col("offset") < F.col("stop"))
    )
    rows = df.filter(coarse).join(table, ["topic", "partition"]).filter(inside)
    return rows.select(*df.columns)


def event_range(
    source: SparkSession | DataFrame,
    ranges: Ranges,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bounded slice of a message log.

    Given a session, the ranges are offsets of a Kafka read. Given a DataFrame
    of messages, such as a landed log, they are a filter on topic, partition
    and offset.
    """
    if isinstance(source, DataFrame):
        return in_ranges(source, ranges)
    # Assigned, not subscribed to: the connector asks for bounds of every
    # partition of a topic it subscribes to, and these may be some of them.
    bounds = {
        "assign": json.dumps({topic: sorted(parts) for topic, parts in ranges.items()}),
        "startingOffsets": offsets_json(ranges, end=False),
        "endingOffsets": offsets_json(ranges, end=True),
    }
    given = {name: value for name, value in (options or {}).items() if name not in SUBSCRIPTIONS}
    return source.read.format(fmt).options(**(given | bounds)).load()
