import os

import pytest
from pyspark.sql import functions as F

from eventlake import align, sinks, sources

NOW = {"availableNow": True}
DDL = "id long, year int, month string, ts int"
COLUMNS = ["id", "year", "month", "ts"]


def batch(spark, start, end, ts=2024010100):
    return spark.range(start, end).selectExpr("id", "2024 year", "'01' month", f"{ts} ts")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_landing_appends_and_reads_back_with_its_types(spark, tmp_path):
    path = str(tmp_path / "zone")
    sinks.write_landing(batch(spark, 0, 5), path, COLUMNS)
    sinks.write_landing(batch(spark, 5, 8), path, COLUMNS, rebalance=False)
    rows = sinks.read_landing(spark, path, DDL)
    assert ids(rows) == list(range(8))
    assert {r.month for r in rows.collect()} == {"01"}
    assert os.path.isdir(f"{path}/year=2024/month=01/ts=2024010100")


@pytest.mark.parametrize(
    "columns, partition, message",
    [
        (["year", "month", "ts"], ("year", "month", "ts"), "not a partition column"),
        (["id", "nope", "ts"], ("ts",), "lack: \\['nope'\\]"),
        (["id"], ("ts",), "not landed: \\['ts'\\]"),
    ],
)
def test_landing_columns_are_checked_up_front(spark, tmp_path, columns, partition, message):
    with pytest.raises(ValueError, match=message):
        sinks.write_landing(batch(spark, 0, 1), str(tmp_path / "z"), columns, partition)
    with pytest.raises(ValueError, match=message):
        sinks.landing_stream(batch(spark, 0, 1), "z", columns, "c", NOW, partition)


def test_one_shared_partition_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        wide = batch(spark, 0, 40_000).withColumn("pad", F.md5(F.col("id").cast("string")))
        sinks.write_landing(wide, str(tmp_path / "zone"), [*COLUMNS, "pad"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = os.listdir(tmp_path / "zone/year=2024/month=01/ts=2024010100")
    assert len([f for f in files if f.endswith(".parquet")]) > 1
    assert sinks.read_landing(spark, str(tmp_path / "zone"), DDL).count() == 40_000


def test_fan_out_computes_the_rows_once(spark, tmp_path):
    rows = batch(spark, 0, 10).withColumn("topic", F.concat(F.lit("t"), F.col("id") % 3))
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        calls.add(1)
        return x

    routes = [
        sinks.Route(str(tmp_path / "a"), [*COLUMNS, "topic"], ("year", "month", "ts")),
        sinks.Route(str(tmp_path / "b"), ["id", "topic"], ("topic",)),
    ]
    sinks.fan_out(rows.withColumn("id", counted("id")), routes)
    assert calls.value == 10
    assert ids(spark.read.parquet(str(tmp_path / "a"))) == list(range(10))
    by_topic = spark.read.parquet(str(tmp_path / "b"))
    assert by_topic.filter("topic = 't1'").count() == 3


def test_a_route_can_take_some_of_the_rows(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    routes = [sinks.Route(good, COLUMNS), sinks.Route(bad, COLUMNS, where="id >= 7")]
    sinks.fan_out(batch(spark, 0, 10), routes)
    assert ids(sinks.read_landing(spark, good, DDL)) == list(range(10))
    assert ids(sinks.read_landing(spark, bad, DDL)) == [7, 8, 9]


@pytest.fixture
def source(spark, tmp_path):
    """A folder of files, and a stream over it that takes one file per batch."""
    folder = str(tmp_path / "source")

    def add(start, end):
        batch(spark, start, end).coalesce(1).write.mode("append").parquet(folder)

    add(0, 10)
    return add, lambda: sources.file_stream(spark, folder, DDL, max_files=1)


def landing(spark, path):
    return sinks.read_landing(spark, path, DDL, batches=True)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_replayed_batch_replaces_itself(spark, tmp_path, source, mode, request):
    """The job dies after its write; the replay lands under another time."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.sources.partitionOverwriteMode"))
    add, stream = source
    zone, checkpoint = str(tmp_path / "zone"), str(tmp_path / "checkpoint")
    route = sinks.Route(zone, COLUMNS, ("year", "month", "ts"))
    attempts = []

    def dying(df):
        attempts.append(1)
        moved = df.withColumn("ts", F.lit(2024010100 + len(attempts)))
        if len(attempts) == 1:
            run = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            sinks.land(moved, [route], f"{run}-0")
            raise RuntimeError("lost driver")
        return moved

    with pytest.raises(Exception, match="lost driver"):
        sinks.landing_batches(stream(), dying, [route], checkpoint, NOW).awaitTermination()
    assert ids(landing(spark, zone)) == list(range(10))
    sinks.landing_batches(stream(), dying, [route], checkpoint, NOW).awaitTermination()
    rows = landing(spark, zone)
    assert ids(rows) == list(range(10))
    assert {r.ts for r in rows.collect()} == {2024010102}
    assert len(attempts) == 2


def test_restart_takes_only_what_is_new_and_other_checkpoints_keep_apart(spark, tmp_path, source):
    add, stream = source
    zone = str(tmp_path / "zone")
    route = sinks.Route(zone, COLUMNS, ("year", "month", "ts"))

    def run(checkpoint):
        place = str(tmp_path / checkpoint)
        sinks.landing_batches(stream(), lambda df: df, [route], place, NOW).awaitTermination()

    run("one")
    add(10, 15)
    run("one")
    rows = landing(spark, zone)
    assert ids(rows) == list(range(15))
    assert {r.batch.rpartition("-")[2] for r in rows.collect()} == {"0", "1"}
    run("two")
    rows = landing(spark, zone)
    assert ids(rows) == sorted([*range(15)] * 2)
    assert len({r.batch.rpartition("-")[0] for r in rows.collect()}) == 2


def test_landing_stream_restarts_without_repeating(spark, tmp_path, source):
    add, stream = source
    zone, checkpoint = str(tmp_path / "zone"), str(tmp_path / "checkpoint")
    sinks.landing_stream(stream(), zone, COLUMNS, checkpoint, NOW).awaitTermination()
    add(10, 12)
    sinks.landing_stream(stream(), zone, COLUMNS, checkpoint, NOW).awaitTermination()
    assert ids(sinks.read_landing(spark, zone, DDL)) == list(range(12))


def test_fixed_interval_trigger(spark, tmp_path, source):
    _, stream = source
    zone = str(tmp_path / "zone")
    query = sinks.landing_stream(
        stream(), zone, COLUMNS, str(tmp_path / "c"), {"processingTime": "1 second"}
    )
    query.processAllAvailable()
    assert query.isActive and query.lastProgress is not None
    query.stop()
    assert ids(sinks.read_landing(spark, zone, DDL)) == list(range(10))


def test_registered_landing_keeps_the_month_as_text(spark, tmp_path):
    path = str(tmp_path / "zone")
    sinks.write_landing(batch(spark, 0, 5), path, COLUMNS)
    schema = batch(spark, 0, 0).schema
    spark.sql("drop table if exists landed_zone")
    sinks.register_landing(spark, "landed_zone", path, schema)
    sinks.register_landing(spark, "landed_zone", path, schema)
    assert spark.table("landed_zone").count() == 5
    assert spark.table("landed_zone").first().month == "01"
    sinks.write_landing(batch(spark, 5, 6, ts=2024010101), path, COLUMNS)
    sinks.register_landing(spark, "landed_zone", path, schema)
    assert spark.table("landed_zone").count() == 6


def test_registered_batch_directories(spark, tmp_path, source):
    _, stream = source
    zone = str(tmp_path / "zone")
    route = sinks.Route(zone, COLUMNS)
    query = sinks.landing_batches(stream(), lambda df: df, [route], str(tmp_path / "c"), NOW, "r1")
    query.awaitTermination()
    schema = batch(spark, 0, 0).schema
    spark.sql("drop table if exists batched_zone")
    sinks.register_landing(spark, "batched_zone", zone, schema, sinks.TIME_PARTITIONS)
    rows = spark.table("batched_zone").collect()
    assert {(r.batch, r.month) for r in rows} == {("r1-0", "01")}
    assert len(rows) == 10
    with pytest.raises(ValueError, match="laid out by"):
        sinks.register_landing(spark, "wrong_zone", zone, schema, ("month", "year"))


def test_landed_partitions_are_added_without_listing_the_zone(spark, tmp_path, monkeypatch):
    zone = str(tmp_path / "zone")
    spark.sql("drop table if exists added_zone")
    route = sinks.Route(zone, COLUMNS, table="added_zone")
    monkeypatch.setattr(sinks, "ADDED_AT_ONCE", 1)
    sinks.land(batch(spark, 0, 5), [route], "r-0")
    # A partition that no registered batch has landed: a listing would find it.
    sinks.write_landing(batch(spark, 90, 95, ts=2023010101), zone, COLUMNS, batch="stray")
    later = batch(spark, 5, 8).unionByName(batch(spark, 8, 9, ts=2024010101))
    sinks.land(later, [route], "r-1")
    assert sorted(r.id for r in spark.table("added_zone").collect()) == list(range(9))
    shown = {r.partition for r in spark.sql("show partitions added_zone").collect()}
    assert len(shown) == 3 and not any("stray" in x for x in shown)
    # A replay whose rows fall elsewhere leaves no row of the earlier attempt.
    sinks.land(batch(spark, 5, 9, ts=2025010101), [route], "r-1")
    assert sorted(r.id for r in spark.table("added_zone").collect()) == list(range(9))
    assert spark.table("added_zone").where("ts = 2025010101").count() == 4


def test_added_partitions_with_unusual_values(spark, tmp_path):
    spark.sql("drop table if exists odd_zone")
    rows = spark.createDataFrame([(1, "it's"), (2, "a/b=c \\d"), (3, None), (4, "")], "id int, key string")
    route = sinks.Route(str(tmp_path / "odd"), ["id", "key"], ["key"], table="odd_zone")
    sinks.land(rows, [route], "x")
    found = {(r.id, r.key, r.batch) for r in spark.table("odd_zone").collect()}
    assert found == {(1, "it's", "x"), (2, "a/b=c \\d", "x"), (3, None, "x"), (4, None, "x")}
    with pytest.raises(ValueError, match="no table"):
        sinks.register_landed(rows, sinks.Route("p", ["id", "key"], ["key"]))


def test_only_the_marker_of_the_last_batch_stays(spark, tmp_path, source):
    add, stream = source
    zone, place = tmp_path / "zone", str(tmp_path / "c")
    add(10, 15)
    route = sinks.Route(str(zone), COLUMNS)
    sinks.landing_batches(stream(), lambda df: df, [route], place, NOW, "r").awaitTermination()
    assert [x.name for x in (zone / "_attempts").iterdir() if x.suffix != ".crc"] == ["r-1"]
    assert ids(landing(spark, str(zone))) == list(range(15))


def test_batch_names_are_directory_names(spark, tmp_path):
    with pytest.raises(ValueError, match="directory name"):
        sinks.land(batch(spark, 0, 1), [sinks.Route(str(tmp_path), COLUMNS)], "a/b")


def test_registered_stream_landing(spark, tmp_path, source):
    _, stream = source
    path = str(tmp_path / "zone")
    sinks.landing_stream(stream(), path, COLUMNS, str(tmp_path / "c"), NOW).awaitTermination()
    spark.sql("drop table if exists streamed_zone")
    sinks.register_landing(spark, "streamed_zone", path, batch(spark, 0, 0).schema, discover=False)
    assert spark.table("streamed_zone").count() == 10


def test_table_columns_and_alignment(spark, tmp_path):
    spark.sql("drop table if exists target")
    spark.sql(f"create table target (id int, ts string, processed boolean) using parquet location '{tmp_path}/t'")
    schema = align.table_columns(spark, "target")
    assert align.table_columns(spark, "spark_catalog.default.target") == schema
    assert schema.names == ["id", "ts", "processed"]
    rows = spark.createDataFrame([("1", 5), ("x", None)], "id string, ts int")
    assert [tuple(r) for r in align.align_to_table(rows, schema).collect()] == [
        (1, "5", False),
        (None, None, False),
    ]
    assert align.align_to_table(rows, schema, ["ts", "id"]).columns == ["ts", "id"]
    with pytest.raises(ValueError, match="lack: \\['ts'\\]"):
        align.align_to_table(rows.drop("ts"), schema)
    with pytest.raises(ValueError, match="does not exist"):
        align.table_columns(spark, "no_such_table")


def test_table_stream(spark, tmp_path, source):
    _, stream = source
    spark.sql("drop table if exists appended")
    spark.sql(f"create table appended (id string, processed boolean) using parquet location '{tmp_path}/t'")
    sinks.table_stream(stream(), "appended", str(tmp_path / "c"), NOW).awaitTermination()
    rows = spark.table("appended").collect()
    assert {(r.id, r.processed) for r in rows} == {(str(i), False) for i in range(10)}


def test_message_stream_sends_three_columns(spark, tmp_path, source):
    _, stream = source
    messages = stream().selectExpr("'t' topic", "cast(id as string) key", "encode(month, 'utf-8') value", "id")
    sent = str(tmp_path / "sent")
    sinks.message_stream(messages, str(tmp_path / "c"), NOW, "parquet", {"path": sent}).awaitTermination()
    assert spark.read.parquet(sent).columns == ["topic", "key", "value"]
