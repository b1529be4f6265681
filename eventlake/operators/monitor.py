"""Error rates, windowed sums, silent periods and stream progress as tables."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.window import Window

PROGRESS_DDL = (
    "query_id string, run_id string, batch_id long, started_at string, "
    "input_rows long, input_rows_per_second double, processed_rows_per_second double"
)


def error_rate(
    df: DataFrame,
    ts: str,
    predicate: Column,
    width: str = "5 minutes",
    threshold: int = 1,
) -> DataFrame:
    """Errors per window, with ``alarm`` where they reach the threshold."""
    errors = df.filter(predicate).groupBy(F.window(ts, width).alias("span"))
    return errors.agg(F.count(F.lit(1)).alias("errors")).select(
        F.col("span.start").alias("window_start"),
        "errors",
        (F.col("errors") >= threshold).alias("alarm"),
    )


def windowed_sum(
    df: DataFrame,
    ts: str,
    amount: Column,
    panes: int = 6,
    slide: str = "5 minutes",
    limit: float = 0,
) -> DataFrame:
    """Sum over a sliding window of ``panes`` slides, ``alarm`` where above ``limit``.

    Rows are summed once per slide; only those sums are copied into the
    windows they belong to.
    """
    step = F.expr(f"INTERVAL '{slide}'")
    pane = df.groupBy(F.window(ts, slide).alias("pane")).agg(F.sum(amount).alias("amount"))
    earliest = F.col("pane.start") - step * (panes - 1)
    starts = pane.select(
        F.explode(F.sequence(earliest, F.col("pane.start"), step)).alias("window_start"),
        "amount",
    )
    return (
        starts.groupBy("window_start")
        .agg(F.sum("amount").alias("total"))
        .withColumn("alarm", F.col("total") > limit)
    )


def error_rate_stream(
    df: DataFrame,
    ts: str,
    predicate: Column,
    width: str = "5 minutes",
    threshold: int = 1,
    lateness: str = "10 minutes",
) -> DataFrame:
    """:func:`error_rate` of a stream, in append mode: each window once, when it is closed.

    A window is closed when a row ``lateness`` or more after its end has been seen, of
    whatever kind; a row that comes later than that is not counted. State is one number per
    open window.
    """
    rows = df.withWatermark(ts, lateness)
    # All rows move the watermark; only errors are counted, and windows without any are left out.
    failed = F.sum(F.when(predicate, 1).otherwise(0))
    counts = rows.groupBy(F.window(ts, width).alias("span")).agg(failed.alias("errors")).where("errors > 0")
    return counts.select(
        F.col("span.start").alias("window_start"), "errors", (F.col("errors") >= threshold).alias("alarm")
    )


def windowed_sum_stream(
    df: DataFrame,
    ts: str,
    amount: Column,
    panes: int = 6,
    slide: str = "5 minutes",
    limit: float = 0,
    lateness: str = "10 minutes",
) -> DataFrame:
    """:func:`windowed_sum` of a stream, in append mode: each window once, when it is closed.

    Rows are summed once per slide; the closed slides are summed into the windows that
    hold them. Late rows as in :func:`error_rate_stream`.
    """
    number, unit = slide.split()
    pane = df.withWatermark(ts, lateness).groupBy(F.window(ts, slide).alias("pane")).agg(F.sum(amount).alias("amount"))
    span = F.window(F.window_time("pane"), f"{int(number) * panes} {unit}", slide).alias("span")
    sums = pane.groupBy(span).agg(F.sum("amount").alias("total"))
    return sums.select(
        F.col("span.start").alias("window_start"), "total", (F.col("total") > limit).alias("alarm")
    )


def no_data_gaps(
    df: DataFrame,
    ts: str,
    limit_seconds: int = 300,
    keys: Sequence[str] = (),
    until: dt.datetime | None = None,
    buckets_per_chunk: int = 4096,
) -> DataFrame:
    """Periods longer than the limit without a row, per key or over all rows.

    With ``until``, the time of the check, the period since the last row counts
    as well.

    Rows are first reduced to the earliest and latest time per bucket of the
    limit's width, within which no gap can exceed the limit. Neighbours are
    then compared inside chunks of buckets, and chunk ends with each other, so
    a window sorts at most ``buckets_per_chunk`` rows, or one row per chunk,
    however many rows a key holds.
    """
    seconds = F.unix_timestamp(F.col(ts).cast("timestamp"))
    bucket = F.floor(seconds / limit_seconds)
    buckets = df.filter(F.col(ts).isNotNull()).groupBy(
        *keys,
        F.floor(bucket / buckets_per_chunk).alias("chunk"),
        bucket.alias("bucket"),
    )
    buckets = buckets.agg(F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))
    chunks = buckets.groupBy(*keys, "chunk").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )

    def between(spans: DataFrame, within: list[str], order: str) -> DataFrame:
        previous = F.lag("last_at").over(Window.partitionBy(*within).orderBy(order))
        return spans.select(
            *keys, previous.alias("gap_start"), F.col("first_at").alias("gap_end")
        )

    gaps = between(buckets, [*keys, "chunk"], "bucket").unionByName(
        between(chunks, list(keys), "chunk")
    )
    if until is not None:
        last = buckets.groupBy(*keys).agg(F.max("last_at").alias("gap_start"))
        kind = df.schema[ts].dataType
        silent = last.filter(F.col("gap_start").isNotNull())
        gaps = gaps.unionByName(silent.withColumn("gap_end", F.lit(until).cast(kind)))
    limit = F.make_dt_interval(secs=F.lit(limit_seconds))
    return gaps.filter(F.col("gap_end") - F.col("gap_start") > limit)


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every micro-batch of the session's streams to Parquet files.

    The streams' own memory holds the last hundred only. Register it with
    :func:`log_progress`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.id), threading.Event())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (
            str(p.id),
            str(p.runId),
            int(p.batchId),
            p.timestamp,
            int(p.numInputRows),
            p.inputRowsPerSecond,
            p.processedRowsPerSecond,
        )
        self.spark.createDataFrame([row], PROGRESS_DDL).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.id), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float | None = None) -> bool:
        """Waits until all progress of a stream that ended is written."""
        return self.ended.setdefault(str(query.id), threading.Event()).wait(seconds)


def log_progress(spark: SparkSession, path: str) -> ProgressLog:
    """Starts a log; ``spark.streams.removeListener`` ends it."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    return log


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """Logged progress, one row per micro-batch."""
    return spark.read.schema(PROGRESS_DDL).parquet(path)
