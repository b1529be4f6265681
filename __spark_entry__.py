
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import (
    ack,
    align,
    avro,
    digest,
    envelope,
    jobs,
    monitor,
    payload,
    registry,
    sinks,
    sources,
    transforms,
)
from eventlake.plans import samples
from eventlake.scratch import new_folder

try:  # operators on training data; the rest works without them
    import corpus_pipeline
    from eventlake.llm import queries as llm
except ModuleNotFoundError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

AVAILABLE_NOW = {"availableNow": True}

# What the streaming and replay queries land: decoded rows with provenance.
LANDED = [
    "kafka_metadata_topic",
    "kafka_metadata_offset",
    "kafka_metadata_partition",
    "kafka_metadata_schemaid",
    "counterparty",
    "key",
    "events",
    "decode_error",
    "year",
    "month",
    "ts",
]
LANDED_DDL = (
    "kafka_metadata_topic string, kafka_metadata_offset long, kafka_metadata_partition int, "
    "kafka_metadata_schemaid string, counterparty string, key string, events string, "
    "decode_error string, year int, month string, ts int"
)
FLAT_DDL = "event_id long, user_id long, user_kind string, value double, errors string, tags string"
EVENT_TIME = "timestamp"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return samples.table(spark, sf, "events")


def _route(folder: str, partition: tuple[str, ...] = sinks.TIME_PARTITIONS) -> sinks.Route:
    return sinks.Route(f"{folder}/landing", LANDED, partition)


def _flat_columns(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """Fields of the flattened event next to the kept columns."""
    return df.select(*keep, F.from_json(text, FLAT_DDL).alias("e")).select(*keep, "e.*")


def _landed_view(landed: DataFrame) -> DataFrame:
    """Landed events with their fields, without the processing-time columns."""
    return _flat_columns(
        landed,
        samples.landed_json(),
        "kafka_metadata_topic",
        "kafka_metadata_partition",
        "counterparty",
        "key",
    )


# ------------------------------------------------------------ header, envelope


def wire_header(spark: SparkSession, sf: str) -> DataFrame:
    frame = F.concat(samples.frame_header(F.col("user_id")), F.encode("props", "utf-8"))
    framed = envelope.add_header(_events(spark, sf).withColumn("value", frame))
    return framed.select("event_id", "kafka_metadata_schemaid", "kafka_magic_byte")


def envelope_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = samples.messages(_events(spark, sf), F.encode("props", "utf-8"))
    return envelope.add_envelope(rows, EVENT_TIME).drop("value", "timestamp", "timestampType")


def counterparty(spark: SparkSession, sf: str) -> DataFrame:
    topics = _events(spark, sf).select("event_id", samples.topic().alias("topic"))
    return topics.select("event_id", "topic", envelope.counterparty(F.col("topic")).alias("counterparty"))


def payload_digests(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.encode("text", "utf-8")
    return samples.table(spark, sf, "documents").select(
        "doc_id",
        digest.payload_hex(raw).alias("payload_hex"),
        digest.payload_base64(raw).alias("payload_base64"),
        digest.hex_to_base64(digest.payload_hex(raw)).alias("hex_base64"),
        digest.payload_sha256(raw).alias("payload_sha256"),
    )


# ------------------------------------------------------------ ranges


def _all_ranges(partitions: int) -> dict[str, dict[int, tuple[int, int]]]:
    """Every topic; partitions alternate between open-ended and bounded ranges."""
    topics = [
        f"eu-{kind}{test}.events.v1" for kind in samples.EVENT_TYPES for test in ("", "-test")
    ]
    bounded = (0, 5_000)
    return {
        name: {p: (100 * p, sources.messages.LATEST) if p % 4 else bounded for p in range(partitions)}
        for name in topics
    }


def offset_range(spark: SparkSession, sf: str) -> DataFrame:
    log = samples.messages(_events(spark, sf), F.encode("props", "utf-8"))
    return sources.event_range(log, _all_ranges(4)).select("topic", "partition", "offset")


def offset_range_many(spark: SparkSession, sf: str) -> DataFrame:
    log = samples.messages(_events(spark, sf), F.encode("props", "utf-8"), partitions=32)
    return sources.event_range(log, _all_ranges(32)).select("topic", "partition", "offset")


# ------------------------------------------------------------ schema registry


def _registry_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The customer table in the shape of a schema registry."""
    machinery = F.col("c_mktsegment") == "MACHINERY"
    return samples.table(spark, sf, "customer").select(
        F.col("c_nationkey").cast("string").alias("counterparty"),
        F.when(machinery, "v3.0").otherwise("v2.2").alias("major_version"),
        F.col("c_mktsegment").alias("minor_version"),
        F.col("c_custkey").alias("schema_id"),
        F.col("c_name").alias("body"),
    )


def latest_schema(spark: SparkSession, sf: str) -> DataFrame:
    return registry.latest_schema(_registry_rows(spark, sf))


def registry_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A registry of one document per party and version, written and read back."""
    root = new_folder(spark, "registry")
    keys = ["counterparty", "major_version", "minor_version", "schema_id"]
    newest = _registry_rows(spark, sf).groupBy("counterparty", "major_version")
    rows = newest.agg(
        F.lit("0").alias("minor_version"),
        F.max("schema_id").alias("schema_id"),
        F.max_by("body", "schema_id").alias("body"),
    )
    rows.select("body", *keys).write.partitionBy(*keys).text(f"{root}/schema_registry")
    documents = registry.read_registry(spark, root, documents="*.txt")
    return documents.withColumn("body", F.rtrim(F.col("body"), F.lit("\n")))


def _framed_by_user(spark: SparkSession, sf: str) -> DataFrame:
    frame = samples.frame_header(F.col("user_id") * 13)
    return envelope.add_header(_events(spark, sf).withColumn("value", frame))


def _customer_schemas(spark: SparkSession, sf: str) -> DataFrame:
    return samples.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("schema_id"), F.col("c_name").alias("body")
    )


def schema_ids(spark: SparkSession, sf: str) -> DataFrame:
    return registry.schema_ids(_framed_by_user(spark, sf))


def schema_lookup(spark: SparkSession, sf: str) -> DataFrame:
    joined = registry.attach_schema(_framed_by_user(spark, sf), _customer_schemas(spark, sf))
    return joined.select("event_id", "kafka_metadata_schemaid", "schema_body")


def schemas_in_use(spark: SparkSession, sf: str) -> DataFrame:
    return registry.schemas_for(_framed_by_user(spark, sf), _customer_schemas(spark, sf))


def missing_schemas(spark: SparkSession, sf: str) -> DataFrame:
    return registry.missing_schemas(_framed_by_user(spark, sf), _customer_schemas(spark, sf))


def schema_table(spark: SparkSession, sf: str) -> DataFrame:
    """Of a table of all schemas, only what the events' ids need is read."""
    store = registry.SchemaTable(spark, new_folder(spark, "schema-table"))
    store.write(_customer_schemas(spark, sf))
    return store.needed(registry.schema_ids(_framed_by_user(spark, sf)))


def schema_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents under a prefix, one per supplier nation."""
    root = new_folder(spark, "documents")
    rows = samples.table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("id"))
    rows.agg(F.max("s_name").alias("value")).write.partitionBy("id").text(f"{root}/schema_id")
    documents = registry.read_documents(spark, root, "schema_id", documents="*.txt")
    number = F.regexp_extract("subject", "^id=([0-9]+)/", 1).cast("int")
    return documents.select(number.alias("id"), F.rtrim("body", F.lit("\n")).alias("body"))


# ------------------------------------------------------------ JSON payloads


def flatten_struct(spark: SparkSession, sf: str) -> DataFrame:
    nested = _events(spark, sf).select(samples.nested_event().alias("event"))
    return payload.flatten_struct(nested, "event")


def drop_struct_keys(spark: SparkSession, sf: str) -> DataFrame:
    nested = _events(spark, sf).select(samples.nested_event().alias("event"))
    return payload.flatten_struct(nested, "event", drop=["user.id", "tags", "absent.key"])


def flatten_text(spark: SparkSession, sf: str) -> DataFrame:
    """Exact bytes of the flattened text, and their digest."""
    rows = samples.json_messages(_events(spark, sf))
    flat = rows.select("offset", payload.flatten_text(F.col("value")).alias("flat"))
    return flat.select(
        F.col("offset").alias("event_id"),
        F.decode("flat", "utf-8").alias("flat"),
        digest.payload_sha256(F.col("flat")).alias("sha256"),
    )


def flatten_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as nested JSON: long texts outside ASCII."""
    turn = F.struct(
        F.struct("conv_id", "turn").alias("at"),
        F.struct(F.col("role"), F.struct(F.col("text").alias("body")).alias("said")).alias("who"),
    )
    raw = F.encode(F.to_json(turn), "utf-8")
    flat = samples.table(spark, sf, "conversations").select(payload.flatten_text(raw).alias("flat"))
    ddl = "at_conv_id long, at_turn long, who_role string, who_said_body string"
    return flat.select(F.from_json(F.decode("flat", "utf-8"), ddl).alias("e")).select("e.*")


def drop_text_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = samples.json_messages(_events(spark, sf))
    flat = payload.drop_keys(F.col("value"), ["user.id", "tags", "absent.key", "tags.inner"])
    return rows.select(F.col("offset").alias("event_id"), F.decode(flat, "utf-8").alias("flat"))


def decode_json(spark: SparkSession, sf: str) -> DataFrame:
    landed = transforms.decode_json(samples.json_messages(_events(spark, sf)), as_of=EVENT_TIME)
    return _flat_columns(
        landed,
        samples.landed_json(),
        "kafka_metadata_offset",
        "kafka_metadata_schemaid",
        "kafka_magic_byte",
        "kafka_metadata_hashed_payload",
        "payload_sha256",
        "decode_error",
        "month",
    )


# ------------------------------------------------------------ Avro payloads


def _avro(spark: SparkSession, sf: str, **options) -> DataFrame:
    events = _events(spark, sf)
    framed = envelope.add_header(samples.avro_messages(events))
    return avro.decode_events(framed, samples.avro_schemas(events), **options)


def avro_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_columns(
        _avro(spark, sf), samples.landed_json(), "kafka_metadata_schemaid", "decode_error"
    )


def avro_roundtrip_joined(spark: SparkSession, sf: str) -> DataFrame:
    """As if the schema store were too large to broadcast."""
    return _flat_columns(
        _avro(spark, sf, max_schema_bytes=0),
        samples.landed_json(),
        "kafka_metadata_schemaid",
        "decode_error",
    )


def avro_event_text(spark: SparkSession, sf: str) -> DataFrame:
    """Exact text of the decoded events."""
    decoded = _avro(spark, sf)
    return decoded.select(F.col("offset").alias("event_id"), samples.landed_json().alias("flat"))


def avro_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as Avro bodies."""
    schema = {
        "type": "record",
        "name": "Document",
        "fields": [
            {"name": "doc_id", "type": "long"},
            {"name": "text", "type": "string"},
            {"name": "source", "type": {"type": "array", "items": "string"}},
            {"name": "n_chars", "type": ["int", "null"]},
        ],
    }
    documents = samples.table(spark, sf, "documents").select(
        F.struct(
            "doc_id",
            "text",
            F.array("source", "lang").alias("source"),
            F.col("n_chars").cast("int").alias("n_chars"),
        ).alias("document")
    )
    framed = envelope.add_header(avro.encode_events(documents, "document", 4_294_967_295, schema))
    schemas = spark.createDataFrame(
        [("4294967295", samples.json.dumps(schema))], "schema_id string, body string"
    )
    decoded = avro.decode_events(framed.drop("document"), schemas)
    ddl = "doc_id long, text string, source string, n_chars int"
    return decoded.select(F.from_json(samples.landed_json(), ddl).alias("e")).select("e.*")


def avro_transform(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    rows = samples.avro_messages(events)
    landed = transforms.decode_avro(rows, samples.avro_schemas(events), as_of=EVENT_TIME)
    raw = F.to_binary("value", F.lit("hex"))
    checked = landed.withColumns(
        {
            "value_bytes": F.octet_length(raw).cast("long"),
            "base64_agrees": F.col("kafka_metadata_hashed_payload") == digest.payload_base64(raw),
            "sha256_agrees": F.col("payload_sha256") == F.sha2(raw, 256),
        }
    )
    return _flat_columns(
        checked,
        samples.landed_json(),
        "kafka_metadata_offset",
        "kafka_magic_byte",
        "value_bytes",
        "base64_agrees",
        "sha256_agrees",
        "month",
        "ts",
    )


def avro_drop_keys(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    landed = transforms.TRANSFORMS["avro_drop_select_keys"](
        samples.avro_messages(events),
        schemas=samples.avro_schemas(events),
        drop=["user.id", "tags"],
        as_of=EVENT_TIME,
    )
    return landed.select(
        F.col("kafka_metadata_offset").alias("event_id"), samples.landed_json().alias("flat")
    )


def avro_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """All messages, some of them damaged in each of the known ways."""
    events = _events(spark, sf)
    frame, kind = F.col("value"), F.pmod("offset", F.lit(10))
    damaged = (
        F.when(kind == 0, F.expr("substring(value, 1, length(value) - 1)"))
        .when(kind == 1, F.expr("substring(value, 1, 4)"))
        .when(kind == 2, F.concat(F.unhex(F.lit("0000000001")), F.expr("substring(value, 6)")))
        .when(kind == 3, F.concat(F.unhex(F.lit("01")), F.expr("substring(value, 2)")))
        .otherwise(frame)
    )
    rows = envelope.add_header(samples.avro_messages(events).withColumn("value", damaged))
    decoded = avro.decode_events(rows, samples.avro_schemas(events))
    marker = F.when(samples.landed_json().endswith('": -1}'), samples.landed_json())
    return decoded.select(
        F.col("offset").alias("event_id"),
        F.col("decode_error").isNotNull().alias("quarantined"),
        "decode_error",
        marker.alias("marker")
    )


# ------------------------------------------------------------ acknowledgements


def ack_payload(spark: SparkSession, sf: str) -> DataFrame:
    results = samples.ack_results(_events(spark, sf))
    return results.select(
        ack.ack_payload().alias("p"),
        ack.ack_payload_map().alias("m"),
        F.col("transaction_id").alias("key"),
    ).select(
        "p.*",
        F.try_element_at("m", F.lit("event_id")).alias("map_event_id"),
        F.try_element_at("m", F.lit("errors")).alias("map_errors"),
        "key",
    )


def reply_topic(spark: SparkSession, sf: str) -> DataFrame:
    results = samples.ack_results(_events(spark, sf))
    return results.select("event_id", ack.reply_topic(F.col("source_topic")).alias("topic"))


def ack_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Exact bytes of the acknowledgement messages."""
    acks = ack.build_acks(samples.ack_results(_events(spark, sf)), 11, samples.ACK_AVRO)
    return acks.select("topic", "key", F.hex("value").alias("value"))


def _ack_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Registry with a version of the acknowledgement schema per event type."""
    return samples.avro_schemas(_events(spark, sf)).select(
        F.lit("core").alias("counterparty"),
        F.lit("v2.2").alias("major_version"),
        F.lit("0").alias("minor_version"),
        F.col("schema_id").cast("long").alias("schema_id"),
        F.lit(samples.json.dumps(samples.ACK_AVRO)).alias("body"),
    )


def ack_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "acks")
    samples.ack_results(_events(spark, sf)).write.parquet(f"{folder}/results")
    results = sources.file_stream(spark, f"{folder}/results", ack.RESULT_DDL, max_files=40)
    query = jobs.produce_acks(
        results,
        _ack_registry(spark, sf),
        "core",
        f"{folder}/checkpoint",
        AVAILABLE_NOW,
        fmt="parquet",
        options={"path": f"{folder}/sent"},
    )
    query.awaitTermination()
    sent = spark.read.parquet(f"{folder}/sent")
    store = _ack_registry(spark, sf).select(F.col("schema_id").cast("string"), "body")
    decoded = avro.decode_events(envelope.add_header(sent), store)
    return decoded.select(
        "topic", "key", F.from_json(samples.landed_json(), "event_id string, errors string").alias("e")
    ).select("topic", "key", "e.*")


def ack_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Each seventh result has no event id, which the schema requires: it is set aside."""
    folder = new_folder(spark, "acks")
    lost = F.when(F.col("event_id").cast("long") % 7 > 0, F.col("event_id"))
    results = samples.ack_results(_events(spark, sf)).withColumn("event_id", lost)
    results.repartition(3).write.parquet(f"{folder}/results")
    query = jobs.produce_acks(
        sources.file_stream(spark, f"{folder}/results", ack.RESULT_DDL, max_files=1),
        _ack_registry(spark, sf),
        "core",
        f"{folder}/checkpoint",
        AVAILABLE_NOW,
        fmt="parquet",
        options={"path": f"{folder}/sent"},
        dead_letters=f"{folder}/lost",
    )
    query.awaitTermination()
    store = _ack_registry(spark, sf).select(F.col("schema_id").cast("string"), "body")
    sent = spark.read.parquet(f"{folder}/sent")
    sent = avro.decode_events(envelope.add_header(sent), store)
    sent = sent.select("key", F.from_json(samples.landed_json(), "event_id string, errors string").alias("e"))
    sent = sent.select("key", "e.event_id", "e.errors", F.lit(None).cast("string").alias("encode_error"))
    dead = spark.read.parquet(f"{folder}/lost")
    return sent.unionByName(
        dead.select(F.col("transaction_id").alias("key"), "event_id", "errors", "encode_error")
    )


# ------------------------------------------------------------ landing


def landing_write(spark: SparkSession, sf: str) -> DataFrame:
    """One directory per day of the events."""
    folder = new_folder(spark, "landing")
    day = F.date_trunc("day", EVENT_TIME)
    landed = transforms.decode_json(samples.json_messages(_events(spark, sf)), as_of=day)
    route = _route(folder)
    sinks.write_landing(landed, route.destination, route.columns, route.partition)
    rows = sinks.read_landing(spark, route.destination, LANDED_DDL)
    return rows.groupBy("year", "month", "ts").agg(F.count("events").alias("n"))


def _ingest(spark: SparkSession, sf: str, sink: str, event_type: str) -> str:
    folder = new_folder(spark, f"ingest-{sink}")
    events = samples.event_table_stream(spark, sf)
    build = samples.json_messages if event_type == "json" else samples.avro_messages
    query = jobs.ingest(
        build(events),
        [_route(folder)],
        f"{folder}/checkpoint",
        AVAILABLE_NOW,
        event_type=event_type,
        schemas=lambda session: samples.avro_schemas(_events(session, sf)),
        sink=sink,
    )
    query.awaitTermination()
    return f"{folder}/landing"


def ingest_batches(spark: SparkSession, sf: str) -> DataFrame:
    path = _ingest(spark, sf, "batch", "avro")
    return _landed_view(sinks.read_landing(spark, path, LANDED_DDL, batches=True))


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = _ingest(spark, sf, "stream", "avro")
    return _landed_view(sinks.read_landing(spark, path, LANDED_DDL))


def ingest_restarted(spark: SparkSession, sf: str) -> DataFrame:
    """Some topics of a message stream, stopped halfway, continued from its checkpoint."""
    folder = new_folder(spark, "restarted")
    events = _events(spark, sf)
    log = samples.avro_messages(events)
    table = registry.SchemaTable(spark, f"{folder}/schemas")
    table.write(samples.avro_schemas(events))
    topics = [f"eu-{kind}.events.v1" for kind in samples.EVENT_TYPES]
    for half in range(2):
        part = log.where(F.pmod("offset", F.lit(2)) == half)
        part.repartition(2).write.mode("append").parquet(f"{folder}/log")
        options = {"path": f"{folder}/log", "maxFilesPerTrigger": "1"}
        stream = sources.event_stream(spark, "parquet", options, log.schema, topics)
        query = jobs.ingest(
            stream, [_route(folder)], f"{folder}/checkpoint", AVAILABLE_NOW, schemas=lambda _: table
        )
        query.awaitTermination()
    landed = sinks.read_landing(spark, f"{folder}/landing", LANDED_DDL, batches=True)
    columns = ("kafka_metadata_topic", "kafka_metadata_offset", "kafka_metadata_schemaid", "decode_error")
    return _flat_columns(landed, samples.landed_json(), *columns)


def ingest_json(spark: SparkSession, sf: str) -> DataFrame:
    path = _ingest(spark, sf, "batch", "json")
    return _landed_view(sinks.read_landing(spark, path, LANDED_DDL, batches=True))


def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "fan-out")
    landed = transforms.decode_json(samples.json_messages(_events(spark, sf)), as_of=EVENT_TIME)
    by_time = _route(folder, ("year", "month"))
    by_topic = sinks.Route(f"{folder}/parallel", LANDED, ("kafka_metadata_topic",))
    sinks.fan_out(landed, [by_time, by_topic])

    def counts(path: str, where: str) -> DataFrame:
        rows = sinks.read_landing(spark, path, LANDED_DDL).groupBy("kafka_metadata_topic")
        return rows.agg(F.count("events").alias("n")).withColumn("landed_in", F.lit(where))

    return counts(by_time.destination, "time").unionByName(counts(by_topic.destination, "topic"))


def backfill(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "backfill")
    events = _events(spark, sf)
    jobs.backfill(
        samples.avro_messages(events),
        _all_ranges(4),
        [_route(folder)],
        run_id="replay",
        schemas=lambda session: samples.avro_schemas(_events(session, sf)),
    )
    rows = spark.read.schema(LANDED_DDL + ", batch string").parquet(f"{folder}/landing")
    return _landed_view(rows)


# ------------------------------------------------------------ tables

TARGET_DDL = "event_id int, user_id smallint, event_type int, value string, ts date, props string"


def _new_table(spark: SparkSession, name: str, ddl: str) -> str:
    folder = new_folder(spark, name)
    table = folder.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet LOCATION '{folder}'")
    return table


def align_to_table(spark: SparkSession, sf: str) -> DataFrame:
    table = _new_table(spark, "aligned", TARGET_DDL)
    schema = align.table_columns(spark, table)
    aligned = align.align_to_table(_events(spark, sf), schema, [*schema.names, "processed"])
    return aligned.withColumn("ts", F.col("ts").cast("string"))


def table_append(spark: SparkSession, sf: str) -> DataFrame:
    ddl = "kafka_metadata_offset long, key int, kafka_metadata_topic string, events string, processed boolean"
    table = _new_table(spark, "appended", ddl)
    messages = samples.avro_messages(samples.event_table_stream(spark, sf))
    landed = transforms.decode_avro(messages, samples.avro_schemas(_events(spark, sf)))
    query = sinks.table_stream(landed, table, new_folder(spark, "checkpoint"), AVAILABLE_NOW)
    query.awaitTermination()
    return _flat_columns(
        spark.table(table), samples.landed_json(), "key", "kafka_metadata_topic", "processed"
    )


def register_landing(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "registered")
    landed = transforms.decode_json(samples.json_messages(_events(spark, sf)), as_of=EVENT_TIME)
    route = _route(folder, ("year", "month"))
    sinks.write_landing(landed, route.destination, route.columns, route.partition)
    table = folder.rsplit("/", 1)[-1].replace("-", "_")
    schema = landed.select(*LANDED).schema
    sinks.register_landing(spark, table, route.destination, schema, route.partition)
    rows = spark.table(table).groupBy("year", "month", "kafka_metadata_topic")
    return rows.agg(F.count("events").alias("n"))


def register_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches by event time; each adds what it landed to the table, and the second is landed twice."""
    folder = new_folder(spark, "batches")
    landed = transforms.decode_json(samples.json_messages(_events(spark, sf)), as_of=EVENT_TIME)
    table = folder.rsplit("/", 1)[-1].replace("-", "_")
    route = replace(_route(folder, ("year", "month")), table=table)
    for half in (0, 1, 1):
        rows = landed.where(F.pmod("kafka_metadata_offset", F.lit(2)) == half)
        sinks.land(rows, [route], f"half-{half}")
    columns = ("kafka_metadata_topic", "kafka_metadata_offset", "year", "month", "batch")
    return _flat_columns(spark.table(table), samples.landed_json(), *columns)


# ------------------------------------------------------------ monitors

def _is_error() -> Column:
    return F.col("event_type") == "error"


def error_rate(spark: SparkSession, sf: str) -> DataFrame:
    rates = monitor.error_rate(_events(spark, sf), "ts", _is_error(), "5 minutes", threshold=2)
    return rates.withColumn("window_start", F.col("window_start").cast("string"))


def windowed_sum(spark: SparkSession, sf: str) -> DataFrame:
    sums = monitor.windowed_sum(_events(spark, sf), "ts", _is_error().cast("int"))
    return sums.withColumn("window_start", F.col("window_start").cast("string"))


def _from_stream(spark: SparkSession, sf: str, monitored: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a monitor emits while the events arrive in four batches, one after the other in time."""
    folder = new_folder(spark, "monitor")
    events = _events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    week = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))
    for at in range(4):
        events.where(week == at).coalesce(1).write.mode("append").parquet(f"{folder}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    out = monitored(stream)
    writer = out.writeStream.format("parquet").outputMode("append").trigger(**AVAILABLE_NOW)
    writer = writer.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    writer.start().awaitTermination()
    rows = spark.read.schema(out.schema).parquet(f"{folder}/out")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz").cast("string"))


def error_rate_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _from_stream(
        spark, sf, lambda rows: monitor.error_rate_stream(rows, "ts", _is_error(), "5 minutes", threshold=2)
    )


def windowed_sum_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _from_stream(
        spark, sf, lambda rows: monitor.windowed_sum_stream(rows, "ts", _is_error().cast("int"))
    )


def _gap_text(gaps: DataFrame) -> DataFrame:
    micros = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("gap_start", "gap_end")]
    others = [c for c in gaps.columns if c not in ("gap_start", "gap_end")]
    return gaps.select(*others, *micros)


def no_data_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return _gap_text(monitor.no_data_gaps(_events(spark, sf), "ts", 300))


def no_data_gaps_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return _gap_text(monitor.no_data_gaps(_events(spark, sf), "ts", 3600, ["event_type"]))


def progress_table(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "progress")
    landed = transforms.decode_json(samples.json_messages(samples.event_table_stream(spark, sf)))
    log = monitor.log_progress(spark, f"{folder}/progress")
    query = sinks.landing_stream(
        landed, f"{folder}/landing", LANDED, f"{folder}/checkpoint", AVAILABLE_NOW
    )
    query.awaitTermination()
    log.wait(query, 60)
    spark.streams.removeListener(log)
    progress = monitor.progress_table(spark, log.path)
    return progress.agg(F.sum("input_rows").alias("input_rows"))


# ------------------------------------------------------------ contract

QUERIES: dict[str, Query] = {
    "wire_header": wire_header,
    "envelope": envelope_columns,
    "counterparty": counterparty,
    "payload_digests": payload_digests,
    "offset_range": offset_range,
    "offset_range_many": offset_range_many,
    "latest_schema": latest_schema,
    "registry_scan": registry_scan,
    "schema_ids": schema_ids,
    "schema_lookup": schema_lookup,
    "schemas_in_use": schemas_in_use,
    "missing_schemas": missing_schemas,
    "schema_table": schema_table,
    "schema_documents": schema_documents,
    "flatten_struct": flatten_struct,
    "drop_struct_keys": drop_struct_keys,
    "flatten_text": flatten_text,
    "flatten_turns": flatten_turns,
    "drop_text_keys": drop_text_keys,
    "decode_json": decode_json,
    "avro_roundtrip": avro_roundtrip,
    "avro_roundtrip_joined": avro_roundtrip_joined,
    "avro_event_text": avro_event_text,
    "avro_documents": avro_documents,
    "avro_transform": avro_transform,
    "avro_drop_keys": avro_drop_keys,
    "avro_quarantine": avro_quarantine,
    "ack_payload": ack_payload,
    "reply_topic": reply_topic,
    "ack_frames": ack_frames,
    "ack_stream": ack_stream,
    "ack_dead_letters": ack_dead_letters,
    "landing_write": landing_write,
    "ingest_batches": ingest_batches,
    "ingest_stream": ingest_stream,
    "ingest_json": ingest_json,
    "ingest_restarted": ingest_restarted,
    "fan_out": fan_out,
    "backfill": backfill,
    "align_to_table": align_to_table,
    "table_append": table_append,
    "register_landing": register_landing,
    "register_batches": register_batches,
    "error_rate": error_rate,
    "windowed_sum": windowed_sum,
    "error_rate_stream": error_rate_stream,
    "windowed_sum_stream": windowed_sum_stream,
    "no_data_gaps": no_data_gaps,
    "no_data_gaps_by_type": no_data_gaps_by_type,
    "progress_table": progress_table,
}


def entry(spark: SparkSession) -> DataFrame:
    """Framed Avro messages, decoded against their schemas and flattened."""
    return avro_roundtrip(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator: (spark, folder of the tables) -> DataFrame."""
    return QUERIES | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


TOPIC_SQL = (
    "'eu-' || event_type || case when user_id % 10 = 0 then '-test' else '' end || '.events.v1'"
)
PARTY_SQL = f"case when contains({TOPIC_SQL}, 'test') then 'core' end"
SCHEMA_SQL = "cast(cast('0x' || substr(md5(event_type), 1, 6) as bigint) as varchar)"
TAGS_SQL = """case when event_type <> 'error'
    then '["' || event_type || '", "' || user_id || '"]' end"""
FLAT_SQL = f"""event_id, user_id, event_type as user_kind, value,
    case when event_type = 'error' then props end as errors, {TAGS_SQL} as tags"""
LANDED_SQL = f"""{TOPIC_SQL} as kafka_metadata_topic,
    cast(user_id % 4 as integer) as kafka_metadata_partition,
    {PARTY_SQL} as counterparty, cast(user_id as varchar) as key, {FLAT_SQL}"""


def _quoted(expression: str) -> str:
    """SQL for a JSON string, for ASCII text whose only special sign is the quote."""
    return f"""'"' || replace({expression}, '"', '\\"') || '"'"""


USER_TEXT = "', \"user_kind\": \"' || event_type || '\"'"
ERRORS_TEXT = f"case when event_type = 'error' then {_quoted('props')} else 'null' end"
TAGS_TEXT = f"coalesce({_quoted(f'({TAGS_SQL})')}, 'null')"
FLAT_TEXT = f"""'{{"event_id": ' || event_id || ', "user_id": ' || user_id || {USER_TEXT}
    || ', "value": ' || value || ', "errors": ' || {ERRORS_TEXT}
    || ', "tags": ' || {TAGS_TEXT} || '}}'"""
DROPPED_TEXT = f"""'{{"event_id": ' || event_id || {USER_TEXT}
    || ', "value": ' || value || ', "errors": ' || {ERRORS_TEXT} || '}}'"""



def _varint_bytes(number: str) -> str:
    """SQL for the byte length of a non-negative number as an Avro long."""
    return f"cast(ceil(greatest(length(ltrim(bin(2 * ({number})), '0')), 1) / 7.0) as bigint)"


def _ranges_sql(partitions: int) -> str:
    part = f"user_id % {partitions}"
    return f"""select {TOPIC_SQL} as topic, cast({part} as integer) as partition,
        event_id as "offset" from events
        where case when {part} % 4 = 0 then event_id < 5000 else event_id >= 100 * ({part}) end"""


def _gaps_sql(key: str, seconds: int) -> str:
    over = f"partition by {key} order by ts" if key else "order by ts"
    keys = f"{key}, " if key else ""
    return f"""select {keys}epoch_us(before) as gap_start, epoch_us(ts) as gap_end from (
        select {keys}ts, lag(ts) over ({over}) as before from events)
        where ts - before > interval {seconds} second"""


AVRO_LENGTH_SQL = f"""5 + {_varint_bytes('event_id')} + {_varint_bytes('user_id')} + 1 + 8
    + 1 + case when event_type = 'error' then 1 + strlen(props) else 0 end
    + case when event_type = 'error' then 0
        else 1 + 1 + strlen(event_type) + 1 + length(cast(user_id as varchar)) end + 1"""

ORACLES: dict[str, str] = {
    "wire_header": """select event_id, cast(user_id as varchar) as kafka_metadata_schemaid,
        '0' as kafka_magic_byte from events""",
    "envelope": f"""select cast(user_id as varchar) as key, {TOPIC_SQL} as kafka_metadata_topic,
        cast(user_id % 4 as integer) as kafka_metadata_partition,
        event_id as kafka_metadata_offset, {PARTY_SQL} as counterparty,
        cast(floor(epoch(ts)) as bigint) as kafka_metadata_kafka_ingested_timestamp,
        cast(year(ts) as integer) as year, strftime(ts, '%m') as month,
        cast(strftime(ts, '%Y%m%d%H') as integer) as ts from events""",
    "counterparty": f"select event_id, {TOPIC_SQL} as topic, {PARTY_SQL} as counterparty from events",
    "payload_digests": """select doc_id, hex(encode(text)) as payload_hex,
        base64(encode(text)) as payload_base64, base64(encode(text)) as hex_base64,
        sha256(text) as payload_sha256 from documents""",
    "offset_range": _ranges_sql(4),
    "offset_range_many": _ranges_sql(32),
    "latest_schema": """select cast(c_nationkey as varchar) as counterparty,
        max(c_custkey) as schema_id, max_by(c_name, c_custkey) as body
        from customer where c_mktsegment <> 'MACHINERY' group by c_nationkey""",
    "registry_scan": """select cast(c_nationkey as varchar) as counterparty,
        case when c_mktsegment = 'MACHINERY' then 'v3.0' else 'v2.2' end as major_version,
        '0' as minor_version, max(c_custkey) as schema_id, max_by(c_name, c_custkey) as body
        from customer group by 1, 2""",
    "schema_ids": "select distinct cast(user_id * 13 as varchar) as schema_id from events",
    "schema_lookup": """select event_id, cast(user_id * 13 as varchar) as kafka_metadata_schemaid,
        c_name as schema_body from events left join customer on user_id * 13 = c_custkey""",
    "schemas_in_use": """select cast(c_custkey as varchar) as schema_id, c_name as body
        from customer where c_custkey in (select user_id * 13 from events)""",
    "missing_schemas": """select distinct cast(user_id * 13 as varchar) as schema_id from events
        where user_id * 13 not in (select c_custkey from customer)""",
    "schema_documents": """select cast(s_nationkey as integer) as id, max(s_name) as body
        from supplier group by 1""",
    "flatten_struct": f"select {FLAT_SQL} from events".replace('", "', '","'),
    "drop_struct_keys": """select event_id, event_type as user_kind, value,
        case when event_type = 'error' then props end as errors from events""",
    "flatten_text": f"select event_id, {FLAT_TEXT} as flat, sha256({FLAT_TEXT}) as sha256 from events",
    "flatten_turns": """select conv_id as at_conv_id, turn as at_turn, role as who_role,
        text as who_said_body from conversations""",
    "drop_text_keys": f"select event_id, {DROPPED_TEXT} as flat from events",
    "decode_json": f"""select event_id as kafka_metadata_offset, 'json' as kafka_metadata_schemaid,
        'json' as kafka_magic_byte, sha256({FLAT_TEXT}) as kafka_metadata_hashed_payload,
        sha256('{{"event_id":' || event_id || ',"user":{{"id":' || user_id || ',"kind":"'
            || event_type || '"}},"value":' || value || ',"errors":' || {ERRORS_TEXT} || ',"tags":'
            || replace(coalesce({TAGS_SQL}, '[]'), '", "', '","') || '}}') as payload_sha256,
        cast(null as varchar) as decode_error, strftime(ts, '%m') as month, {FLAT_SQL} from events""",
    "avro_roundtrip": f"""select {SCHEMA_SQL} as kafka_metadata_schemaid,
        cast(null as varchar) as decode_error, {FLAT_SQL} from events""",
    "avro_event_text": f"select event_id, {FLAT_TEXT} as flat from events",
    "avro_documents": """select doc_id, text, '["' || source || '", "' || lang || '"]' as source,
        cast(n_chars as integer) as n_chars from documents""",
    "avro_transform": f"""select event_id as kafka_metadata_offset, '0' as kafka_magic_byte,
        {AVRO_LENGTH_SQL} as value_bytes, true as base64_agrees, true as sha256_agrees,
        strftime(ts, '%m') as month, cast(strftime(ts, '%Y%m%d%H') as integer) as ts,
        {FLAT_SQL} from events""",
    "avro_drop_keys": f"select event_id, {DROPPED_TEXT} as flat from events",
    "avro_quarantine": f"""select event_id, event_id % 10 < 4 as quarantined,
        case event_id % 10 when 0 then 'bad_body' when 1 then 'short_frame'
            when 2 then 'unknown_schema' when 3 then 'bad_magic' end as decode_error,
        case event_id % 10 when 0 then '{{"' || {SCHEMA_SQL} || '": -1}}'
            when 1 then '{{"null": -1}}' when 2 then '{{"1": -1}}' end as marker from events""",
    "ack_payload": """select cast(event_id as varchar) as event_id,
        case when event_type = 'error' then props end as errors,
        cast(event_id as varchar) as map_event_id,
        case when event_type = 'error' then props end as map_errors,
        cast(user_id as varchar) as key from events""",
    "reply_topic": f"""select cast(event_id as varchar) as event_id,
        regexp_replace({TOPIC_SQL}, 'events', '', 'g') as topic from events""",
    "ack_frames": f"""select replace({TOPIC_SQL}, 'events', '') as topic,
        cast(user_id as varchar) as key,
        '000000000B' || printf('%02X', 2 * strlen(cast(event_id as varchar)))
            || hex(encode(cast(event_id as varchar)))
            || case when event_type = 'error'
                then '02' || printf('%02X', 2 * strlen(props)) || hex(encode(props))
                else '00' end as value from events""",
    "ack_stream": f"""select replace({TOPIC_SQL}, 'events', '') as topic,
        cast(user_id as varchar) as key, cast(event_id as varchar) as event_id,
        case when event_type = 'error' then props end as errors from events""",
    "ack_dead_letters": """select cast(user_id as varchar) as key,
        case when event_id % 7 > 0 then cast(event_id as varchar) end as event_id,
        case when event_type = 'error' then props end as errors,
        case when event_id % 7 = 0 then 'bad_value' end as encode_error from events""",
    "landing_write": """select cast(year(ts) as integer) as year, strftime(ts, '%m') as month,
        cast(strftime(ts, '%Y%m%d00') as integer) as ts, count(*) as n from events group by 1, 2, 3""",
    "ingest_batches": f"select {LANDED_SQL} from events",
    "ingest_restarted": f"""select {TOPIC_SQL} as kafka_metadata_topic,
        event_id as kafka_metadata_offset, {SCHEMA_SQL} as kafka_metadata_schemaid,
        cast(null as varchar) as decode_error, {FLAT_SQL} from events where user_id % 10 <> 0""",
    "fan_out": f"""select {TOPIC_SQL} as kafka_metadata_topic, count(*) as n, landed_in
        from events, (values ('time'), ('topic')) as t(landed_in) group by 1, 3""",
    "backfill": f"""select {LANDED_SQL} from events
        where case when user_id % 4 = 0 then event_id < 5000
            else event_id >= 100 * (user_id % 4) end""",
    "align_to_table": """select try_cast(event_id as integer) as event_id,
        try_cast(user_id as smallint) as user_id, try_cast(event_type as integer) as event_type,
        cast(value as varchar) as value, cast(cast(ts as date) as varchar) as ts, props,
        false as processed from events""",
    "table_append": f"""select cast(user_id as integer) as key, {TOPIC_SQL} as kafka_metadata_topic,
        false as processed, {FLAT_SQL} from events""",
    "register_landing": f"""select cast(year(ts) as integer) as year, strftime(ts, '%m') as month,
        {TOPIC_SQL} as kafka_metadata_topic, count(*) as n from events group by 1, 2, 3""",
    "register_batches": f"""select {TOPIC_SQL} as kafka_metadata_topic,
        event_id as kafka_metadata_offset, cast(year(ts) as integer) as year,
        strftime(ts, '%m') as month, 'half-' || event_id % 2 as batch, {FLAT_SQL} from events""",
    "error_rate": """select strftime(time_bucket(interval 5 minute, ts), '%Y-%m-%d %H:%M:%S')
        as window_start, count(*) as errors, count(*) >= 2 as alarm
        from events where event_type = 'error' group by 1""",
    "windowed_sum": """select strftime(start, '%Y-%m-%d %H:%M:%S') as window_start,
        cast(sum(failed) as bigint) as total, sum(failed) > 0 as alarm from (
            select time_bucket(interval 5 minute, ts) - to_minutes(5 * cast(i as integer)) as start,
                case when event_type = 'error' then 1 else 0 end as failed
            from events, range(6) as r(i)) group by 1""",
    "no_data_gaps": _gaps_sql("", 300),
    "no_data_gaps_by_type": _gaps_sql("event_type", 3600),
    "progress_table": "select count(*) as input_rows from events",
}
# Of a stream, the windows that are closed once the last row is ten minutes past their end.
for _name, _minutes in (("error_rate", 5), ("windowed_sum", 30)):
    ORACLES[f"{_name}_stream"] = f"""select * from ({ORACLES[_name]})
        where strptime(window_start, '%Y-%m-%d %H:%M:%S') + interval {_minutes + 10} minute
            <= (select max(ts) from events)"""
# The same rows reached another way.
ORACLES["avro_roundtrip_joined"] = ORACLES["avro_roundtrip"]
ORACLES["schema_table"] = ORACLES["schemas_in_use"]
ORACLES["ingest_stream"] = ORACLES["ingest_batches"]
ORACLES["ingest_json"] = ORACLES["ingest_batches"]


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same result for every query that SQL can express."""
    return ORACLES | (llm.oracle_sql() if llm else {})
