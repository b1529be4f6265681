import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventlake import monitor, sinks, sources

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def ticks(spark):
    """One key holds most rows; times repeat, cluster and leave holes."""
    rng = random.Random(7)
    rows = [(k, START + dt.timedelta(seconds=rng.choice([0, 1, 59.5, 300, 300.5]) + 700 * rng.randrange(60)))
            for k in "aaaaaaaaab" for _ in range(40)]
    rows.append(("a", None))
    return rows, spark.createDataFrame(rows, "key string, ts timestamp_ntz")


def brute_gaps(rows, limit):
    times = sorted(t for _, t in rows if t)
    return sorted((a, b) for a, b in zip(times, times[1:]) if (b - a).total_seconds() > limit)


@pytest.mark.parametrize("limit", [1, 59, 300, 3600])
@pytest.mark.parametrize("chunk", [1, 3, 4096])
def test_gaps(ticks, limit, chunk):
    rows, df = ticks
    found = monitor.no_data_gaps(df, "ts", limit, buckets_per_chunk=chunk)
    assert sorted(map(tuple, found.collect())) == brute_gaps(rows, limit)
    found = monitor.no_data_gaps(df, "ts", limit, ["key"], buckets_per_chunk=chunk).collect()
    for key in "ab":
        mine = sorted((r.gap_start, r.gap_end) for r in found if r.key == key)
        assert mine == brute_gaps([r for r in rows if r[0] == key], limit)


def test_a_gap_of_exactly_the_limit_is_none(spark):
    rows = [(START + dt.timedelta(seconds=s),) for s in (0, 300, 601)]
    gaps = monitor.no_data_gaps(spark.createDataFrame(rows, "ts timestamp"), "ts", 300)
    assert [(g.gap_end - g.gap_start).total_seconds() for g in gaps.collect()] == [301]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_silence_up_to_the_time_of_the_check(spark, kind):
    rows = [("a", START), ("b", START + dt.timedelta(seconds=400)), ("c", None)]
    df = spark.createDataFrame(rows, f"key string, ts {kind}")
    check = START + dt.timedelta(seconds=600)
    gaps = monitor.no_data_gaps(df, "ts", 300, ["key"], until=check)
    assert [tuple(g) for g in gaps.collect()] == [("a", START, check)]
    assert monitor.no_data_gaps(df, "ts", 500, until=check).count() == 0
    assert monitor.no_data_gaps(df.limit(0), "ts", 500, until=check).count() == 0


def test_neighbours_are_compared_over_one_shared_exchange(ticks):
    _, df = ticks
    gaps = monitor.no_data_gaps(df, "ts")
    gaps.collect()
    assert "ReusedExchange" in gaps._jdf.queryExecution().executedPlan().toString()


def test_error_rate_and_alarm(spark):
    rows = [(START + dt.timedelta(seconds=s), s % 2) for s in (0, 1, 3, 299, 300, 301)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, bad int")
    rates = monitor.error_rate(df, "ts", F.col("bad") == 1, threshold=2).orderBy("window_start")
    assert [(r.window_start, r.errors, r.alarm) for r in rates.collect()] == [
        (START, 3, True),
        (START + dt.timedelta(minutes=5), 1, False),
    ]


def test_windowed_sum_matches_brute_force(ticks):
    rows, df = ticks
    sums = monitor.windowed_sum(df.filter("ts is not null"), "ts", F.lit(1), panes=3, limit=20)
    width, slide = dt.timedelta(minutes=15), dt.timedelta(minutes=5)
    times = [t for _, t in rows if t]
    for row in sums.collect():
        total = sum(row.window_start <= t < row.window_start + width for t in times)
        assert (row.total, row.alarm) == (total, total > 20)
    assert sums.agg(F.sum("total")).first()[0] == 3 * len(times)
    assert (min(r.window_start for r in sums.collect()) - START) == -2 * slide


def test_the_rows_are_reduced_before_any_shuffle(ticks):
    _, df = ticks
    for monitored in (
        monitor.error_rate(df, "ts", F.col("key") == "a"),
        monitor.windowed_sum(df, "ts", F.lit(1)),
        monitor.no_data_gaps(df, "ts"),
    ):
        plan = monitored._jdf.queryExecution().executedPlan().toString()
        below = plan.splitlines()
        scans = [i for i, line in enumerate(below) if "ExistingRDD" in line]
        for at in scans:
            path = [line for line in below[:at] if "Exchange" in line or "HashAggregate" in line]
            assert "HashAggregate" in path[-1] and "partial_" in path[-1]


def test_progress(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = sources.file_stream(spark, str(tmp_path / "in"), "id long")
    messages = stream.selectExpr("'t' topic", "cast(id as string) key", "cast(null as binary) value")
    log = monitor.log_progress(spark, str(tmp_path / "progress"))
    query = sinks.message_stream(
        messages, str(tmp_path / "c"), {"availableNow": True}, "parquet", {"path": str(tmp_path / "out")}
    )
    query.awaitTermination()
    assert log.wait(query, 60)
    spark.streams.removeListener(log)
    progress = monitor.progress_table(spark, log.path)
    assert progress.agg(F.sum("input_rows")).first()[0] == 10
    assert {r.query_id for r in progress.collect()} == {query.id}


def test_more_batches_than_the_stream_remembers(spark, tmp_path, request):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates"))
    folder = str(tmp_path / "in")
    spark.range(12).repartition(12).write.parquet(folder)
    log = monitor.log_progress(spark, str(tmp_path / "progress"))
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(folder)
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    assert log.wait(query, 60)
    spark.streams.removeListener(log)
    rows = monitor.progress_table(spark, log.path).where("input_rows > 0").collect()
    assert len(rows) == len({r.batch_id for r in rows}) > 5
    assert len(query.recentProgress) < len(rows)


@pytest.mark.parametrize("sliding", [False, True])
def test_streamed_windows_equal_the_batch_until_rows_are_too_late(spark, tmp_path, sliding):
    """Four batches; rows up to ten minutes late count, the one that is later does not."""
    minute = dt.timedelta(minutes=1)
    batches = [
        [(START + m * minute, m % 3 == 0) for m in range(0, 40)],
        [(START + m * minute, True) for m in (41, 38, 33, 60)],
        [(START + 20 * minute, True), (START + 75 * minute, True)],
        [(START + 200 * minute, False)],
    ]
    ddl = "at timestamp, bad boolean"
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counted = [r for rows in batches for r in rows if r != (START + 20 * minute, True)]
    table = spark.createDataFrame(counted, ddl)
    if sliding:
        amount = F.col("bad").cast("int")
        out, batch = monitor.windowed_sum_stream(stream, "at", amount), monitor.windowed_sum(table, "at", amount)
        width = 30
    else:
        out, batch = monitor.error_rate_stream(stream, "at", F.col("bad")), monitor.error_rate(table, "at", F.col("bad"))
        width = 5
    writer = out.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer = writer.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
    writer.start().awaitTermination()
    found = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    closed = [tuple(r) for r in batch.collect() if r[0] + width * minute <= START + 190 * minute]
    assert found == sorted(closed) and found
