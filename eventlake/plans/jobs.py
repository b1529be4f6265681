"""End-to-end jobs: consume, acknowledge, replay."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake import sources
from eventlake.functions import envelope
from eventlake.operators import ack, registry
from eventlake.plans.transforms import TRANSFORMS
from eventlake.streaming import sinks

# The time of a micro-batch, fixed before it is handed over: a replay has the same.
AS_OF = "_as_of"

SchemaSource = Callable[[SparkSession], DataFrame]

# Columns known before a message is decoded.
ENVELOPE = {
    "kafka_metadata_topic",
    "kafka_metadata_offset",
    "kafka_metadata_partition",
    "counterparty",
    "key",
    *envelope.TIME_PARTITIONS,
}


def _transform(
    event_type: str,
    schemas: SchemaSource | None,
    drop: Sequence[str],
    as_of: Column | str | None,
    arrange: Sequence[str] | None = None,
) -> Callable[[DataFrame], DataFrame]:
    if event_type not in TRANSFORMS:
        raise ValueError(f"unknown event type {event_type!r}, expected one of {[*TRANSFORMS]}")
    if schemas is None and event_type != "json":
        raise ValueError(f"event type {event_type!r} needs schemas")

    def apply(df: DataFrame) -> DataFrame:
        known = schemas(df.sparkSession) if schemas is not None else None
        return TRANSFORMS[event_type](df, schemas=known, drop=drop, as_of=as_of, arrange=arrange)

    return apply


def _arranged(
    routes: Sequence[sinks.Route], constant: bool
) -> tuple[Sequence[str] | None, Sequence[sinks.Route]]:
    """Columns to shuffle the undecoded messages by, and the routes that remain to be.

    With one route that takes all rows the shuffle before its write moves to
    before the decoding. ``constant``: all rows share their time, so there is
    nothing to bring together and the shuffle, without columns, only evens out.
    """
    if len(routes) != 1 or not routes[0].rebalance or routes[0].where is not None:
        return None, routes
    (route,) = routes
    if not set(route.partition) <= ENVELOPE:
        return None, routes
    single = constant and set(route.partition) <= {*envelope.TIME_PARTITIONS}
    return () if single else route.partition, [replace(route, rebalance=False)]


def ingest(
    stream: DataFrame,
    routes: Sequence[sinks.Route],
    checkpoint: str,
    trigger: sinks.Trigger,
    event_type: str = "avro",
    schemas: SchemaSource | None = None,
    drop: Sequence[str] = (),
    sink: str = "batch",
    as_of: Column | str | None = None,
    run_id: str | None = None,
) -> StreamingQuery:
    """Message stream to landing zone.

    ``schemas`` is called with the session: per micro-batch for the ``batch``
    sink, which therefore sees schemas that arrive later, and once at the start
    for the ``stream`` sink.
    """
    if sink == "batch":
        arrange, routes = _arranged(routes, constant=as_of is None)
        transform = _transform(event_type, schemas, drop, AS_OF, arrange)
        time = F.current_timestamp() if as_of is None else as_of
        timed = stream.withColumn(AS_OF, F.col(time) if isinstance(time, str) else time)
        return sinks.landing_batches(timed, transform, routes, checkpoint, trigger, run_id)
    if sink != "stream":
        raise ValueError(f"unknown sink {sink!r}, expected 'batch' or 'stream'")
    if len(routes) != 1:
        raise ValueError("the stream sink has one destination")
    (route,) = routes
    landed = _transform(event_type, schemas, drop, as_of)(stream)
    return sinks.landing_stream(
        landed if route.where is None else landed.filter(route.where), route.destination, route.columns, checkpoint, trigger, route.partition
    )


def backfill(
    source: SparkSession | DataFrame,
    ranges: sources.messages.Ranges,
    routes: Sequence[sinks.Route],
    run_id: str,
    event_type: str = "avro",
    schemas: SchemaSource | None = None,
    drop: Sequence[str] = (),
    as_of: Column | str | None = None,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> bool:
    """Replay a bounded slice of the log into the landing zone.

    False when the slice is empty. The test for that reads the slice before it
    is decoded. Running the same ``run_id`` again replaces what it landed.
    """
    if as_of is None:
        # Processing time puts all rows of a slice into one partition already.
        routes = [
            replace(r, rebalance=r.rebalance and not set(r.partition) <= {*envelope.TIME_PARTITIONS})
            for r in routes
        ]
    arrange, routes = _arranged(routes, constant=False)
    transform = _transform(event_type, schemas, drop, as_of, arrange)
    messages = sources.event_range(source, ranges, fmt, options)
    if messages.isEmpty():
        return False
    sinks.land(transform(messages), routes, run_id)
    return True


def produce_acks(
    results: DataFrame,
    registry_table: DataFrame,
    counterparty: str,
    checkpoint: str,
    trigger: sinks.Trigger,
    major: str = "2.2",
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    dead_letters: str | None = None,
) -> StreamingQuery:
    """Stream of processing results to acknowledgement messages.

    Encodes with the counterparty's newest schema of the major version. A result that the
    schema does not allow stops the stream, or, with a folder ``dead_letters``, is set
    aside there with its ``encode_error`` while the stream goes on.
    """
    newest = registry.latest_schema(registry_table, major, counterparty).first()
    if newest is None:
        raise ValueError(f"no schema v{major} for counterparty {counterparty!r}")
    if dead_letters is None:
        acks = ack.build_acks(results, newest.schema_id, newest.body)
        return sinks.message_stream(acks, checkpoint, trigger, fmt, options)
    acks = ack.build_acks(results, newest.schema_id, newest.body, error=sinks.ENCODE_ERROR)
    return sinks.message_batches(acks, results.columns, checkpoint, trigger, dead_letters, fmt, options)
