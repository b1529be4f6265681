import base64
import json
import os
import subprocess
import sys

import pytest
from slow_avro import frame

from eventlake import ack, jobs, registry, sinks, sources

NOW = {"availableNow": True}
COLUMNS = ["kafka_metadata_topic", "kafka_metadata_offset", "events", "decode_error", "year", "month", "ts"]
DDL = (
    "kafka_metadata_topic string, kafka_metadata_offset long, events string, "
    "decode_error string, year int, month string, ts int"
)
MESSAGES = sources.messages.MESSAGE_DDL


def schema(name):
    return {"type": "record", "name": "R", "fields": [{"name": name, "type": "long"}]}


def put_schema(root, schema_id):
    folder = root / f"store/schema_id/{schema_id}"
    folder.mkdir(parents=True)
    (folder / "schema.json").write_text(json.dumps(schema(f"v{schema_id}")))


def add(spark, root, frames, first=0):
    rows = [(b"k", f, "eu-live.events.v1", 0, first + i, None, 0) for i, f in enumerate(frames)]
    df = spark.createDataFrame(rows, MESSAGES)
    df.coalesce(1).write.mode("append").parquet(str(root / "log"))


def framed(schema_id, value):
    return frame(schema_id, schema(f"v{schema_id}"), {f"v{schema_id}": value})


def landed(df):
    return sorted(
        (r.kafka_metadata_offset, r.events and base64.b64decode(r.events).decode(), r.decode_error)
        for r in df.collect()
    )


@pytest.fixture
def world(spark, tmp_path):
    put_schema(tmp_path, 1)
    add(spark, tmp_path, [framed(1, 10), framed(2, 20), b"\0"])
    return tmp_path


def run(spark, root, sink, checkpoint, **options):
    route = sinks.Route(str(root / f"zone-{checkpoint}"), COLUMNS, ("year", "month", "ts"))
    stream = sources.event_stream(spark, "parquet", {"path": str(root / "log")}, MESSAGES)
    options = {"schemas": lambda s: registry.read_schema_store(s, str(root / "store"))} | options
    jobs.ingest(stream, [route], str(root / checkpoint), NOW, sink=sink, **options).awaitTermination()
    return sinks.read_landing(spark, route.destination, DDL, batches=sink == "batch")


FIRST = [
    (0, '{"v1": 10}', None),
    (1, '{"2": -1}', "unknown_schema"),
    (2, '{"null": -1}', "short_frame"),
]


def test_both_sinks_land_the_same_rows(spark, world):
    assert landed(run(spark, world, "batch", "b")) == FIRST
    assert landed(run(spark, world, "stream", "s")) == FIRST


def test_a_schema_that_arrives_later_is_seen_by_the_next_batch(spark, world):
    run(spark, world, "batch", "b")
    put_schema(world, 2)
    add(spark, world, [framed(2, 30)], first=3)
    assert landed(run(spark, world, "batch", "b")) == [*FIRST, (3, '{"v2": 30}', None)]


def test_a_failed_read_of_the_store_fails_the_batch_and_is_replayed(spark, world):
    def broken(session):
        raise OSError("store is away")

    with pytest.raises(Exception, match="store is away"):
        run(spark, world, "batch", "b", schemas=broken)
    assert landed(run(spark, world, "batch", "b")) == FIRST


def test_json_and_key_dropping_event_types(spark, world):
    add(spark, world, [b'{"a":{"b":1,"c":2}}'], first=9)
    rows = landed(run(spark, world, "batch", "j", event_type="json", schemas=None, drop=["a.b"]))
    assert rows[-1] == (9, '{"a_c": 2}', None)
    assert {error for *_, error in rows[:-1]} == {"bad_json"}
    rows = landed(run(spark, world, "batch", "d", event_type="avro_drop_select_keys", drop=["v1"]))
    assert rows[0] == (0, "{}", None)


@pytest.mark.parametrize(
    "options, message",
    [
        ({"event_type": "xml"}, "unknown event type"),
        ({"schemas": None}, "needs schemas"),
        ({"sink": "file"}, "unknown sink"),
    ],
)
def test_wrong_arguments(spark, world, options, message):
    with pytest.raises(ValueError, match=message):
        run(spark, world, options.pop("sink", "batch"), "x", **options)


def test_the_stream_sink_has_one_route(spark, world):
    route = sinks.Route("z", COLUMNS, ("ts",))
    stream = sources.event_stream(spark, "parquet", {"path": str(world / "log")}, MESSAGES)
    with pytest.raises(ValueError, match="one destination"):
        jobs.ingest(stream, [route, route], "c", NOW, event_type="json", sink="stream")


def test_backfill_is_bounded_and_repeatable(spark, world):
    log = spark.read.parquet(str(world / "log"))
    zone = str(world / "zone")
    route = sinks.Route(zone, COLUMNS, ("year", "month", "ts"))

    def replay(ranges):
        return jobs.backfill(
            log,
            {"eu-live.events.v1": ranges},
            [route],
            run_id="r1",
            schemas=lambda s: registry.read_schema_store(s, str(world / "store")),
        )

    assert replay({0: (5, 9)}) is False
    assert replay({0: (0, 2)}) is True
    assert replay({0: (0, 2)}) is True
    assert landed(spark.read.schema(DDL + ", batch string").parquet(zone)) == FIRST[:2]


def test_backfill_by_processing_time_writes_where_it_decodes(spark, world):
    """Three input files give three output files: no shuffle in between."""
    add(spark, world, [framed(1, 11)], first=3)
    add(spark, world, [framed(1, 12)], first=4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "2KB")
    try:
        log = spark.read.parquet(str(world / "log"))
        route = sinks.Route(str(world / "zone"), COLUMNS)
        options = {"schemas": lambda s: registry.read_schema_store(s, str(world / "store"))}
        jobs.backfill(log, {"eu-live.events.v1": {0: (0, -1)}}, [route], run_id="r", **options)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    rows = spark.read.schema(DDL + ", batch string").parquet(route.destination)
    assert len(landed(rows)) == 5
    assert len(rows.inputFiles()) == 3


def test_several_routes_of_one_stream(spark, world):
    good = sinks.Route(str(world / "good"), COLUMNS, where="decode_error IS NULL")
    bad = sinks.Route(str(world / "bad"), COLUMNS, ("decode_error",), "decode_error IS NOT NULL")
    stream = sources.event_stream(spark, "parquet", {"path": str(world / "log")}, MESSAGES)
    store = {"schemas": lambda s: registry.read_schema_store(s, str(world / "store"))}
    jobs.ingest(stream, [good, bad], str(world / "c"), NOW, run_id="r", **store).awaitTermination()
    assert landed(sinks.read_landing(spark, good.destination, DDL, batches=True)) == FIRST[:1]
    assert landed(sinks.read_landing(spark, bad.destination, DDL, batches=True)) == FIRST[1:]


ACK = {
    "type": "record",
    "name": "Ack",
    "fields": [{"name": "event_id", "type": "string"}, {"name": "errors", "type": ["null", "string"]}],
}


def test_acknowledgements(spark, tmp_path):
    results = [
        ("e1", "t1", "eu-events.events.v1", None, 2024, 1, 2024010100),
        ("e2", "t2", "eu-live.events.v1", "late", 2024, 1, 2024010100),
    ]
    spark.createDataFrame(results, ack.RESULT_DDL).write.parquet(str(tmp_path / "results"))
    parties = spark.createDataFrame(
        [("x", "v2.2", "0", 3, "{}"), ("x", "v2.2", "1", 11, json.dumps(ACK)), ("y", "v2.2", "0", 99, "{}")],
        "counterparty string, major_version string, minor_version string, schema_id long, body string",
    )
    stream = sources.file_stream(spark, str(tmp_path / "results"), ack.RESULT_DDL, max_files=1)
    sent = str(tmp_path / "sent")
    query = jobs.produce_acks(
        stream, parties, "x", str(tmp_path / "c"), NOW, fmt="parquet", options={"path": sent}
    )
    query.awaitTermination()
    rows = {r.key: (r.topic, bytes(r.value)) for r in spark.read.parquet(sent).collect()}
    assert rows == {
        "t1": ("eu-..v1", frame(11, ACK, {"event_id": "e1", "errors": (0, None)})),
        "t2": ("eu-live..v1", frame(11, ACK, {"event_id": "e2", "errors": (1, "late")})),
    }
    with pytest.raises(ValueError, match="no schema"):
        jobs.produce_acks(stream, parties, "z", "c", NOW)


def test_acks_that_cannot_be_encoded_are_set_aside_also_on_a_replay(spark, tmp_path):
    """A null in a required field, twice: the stream goes on, and a batch run again leaves no second copy."""
    rows = [("e1", "t1", "a.events", None, 2024, 1, 1), (None, "t2", "a.events", "x", 2024, 1, 1), ("e3", "t3", "a.events", "late", 2024, 1, 1)]
    folder = str(tmp_path / "results")
    parties = spark.createDataFrame(
        [("x", "v2.2", "1", 11, json.dumps(ACK))],
        "counterparty string, major_version string, minor_version string, schema_id long, body string",
    )
    for row in rows:
        spark.createDataFrame([row], ack.RESULT_DDL).coalesce(1).write.mode("append").parquet(folder)
    sent, lost, checkpoint = (str(tmp_path / name) for name in ("sent", "lost", "c"))

    def run():
        stream = sources.file_stream(spark, folder, ack.RESULT_DDL, max_files=1)
        query = jobs.produce_acks(
            stream, parties, "x", checkpoint, NOW, fmt="parquet", options={"path": sent}, dead_letters=lost
        )
        query.awaitTermination()
        good = sorted(r.key for r in spark.read.parquet(sent).collect())
        dead = [(r.transaction_id, r.event_id, r.errors, r.encode_error) for r in spark.read.parquet(lost).collect()]
        return good, dead

    expected = (["t1", "t3"], [("t2", None, "x", "bad_value")])
    assert run() == expected
    # As if the driver had died after the last batch was written and before it was committed.
    os.remove(max((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name)))
    for crc in (tmp_path / "c" / "commits").glob(".*.crc"):
        os.remove(crc)
    assert run() == expected
    spark.createDataFrame([(None, "t4", "a.events", None, 2024, 1, 1)], ack.RESULT_DDL).write.mode("append").parquet(folder)
    assert run() == (["t1", "t3"], [*expected[1], ("t4", None, None, "bad_value")])


def test_executors_need_not_have_the_package(tmp_path):
    """Workers started elsewhere can decode, encode and flatten."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("avro_roundtrip", "avro_roundtrip_joined", "flatten_text", "ack_frames"):
    assert contract.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    contract.queries()[name](spark, "/root/testdata/sf0.001").collect()
"""
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
