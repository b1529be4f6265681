"""Landing zones, catalog tables and message topics.

Nothing here catches a failed write: a micro-batch that raises is not
committed, and Spark runs it again from the checkpoint.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventlake.functions.envelope import TIME_PARTITIONS
from eventlake.operators import align, avro
from eventlake.scratch import file_system, new_folder, remove

Trigger = Mapping[str, object]

# Innermost partition column of zones that are written batch by batch.
BATCH = "batch"


@dataclass(frozen=True)
class Route:
    """One destination of landed rows.

    ``rebalance`` as in :func:`write_landing`. ``where`` is a SQL condition on the rows it takes, for instance
    ``decode_error IS NOT NULL`` for a quarantine zone. ``table`` is a catalog table over
    the zone, to which each batch adds the partitions that it landed.
    """

    destination: str
    columns: Sequence[str]
    partition: Sequence[str] = TIME_PARTITIONS
    where: str | None = None
    rebalance: bool = True
    table: str | None = None


def _check_columns(df: DataFrame, columns: Sequence[str], partition: Sequence[str]) -> None:
    missing = [name for name in (*columns, *partition) if name not in df.columns]
    if missing:
        raise ValueError(f"columns to land that the rows lack: {missing}")
    outside = [name for name in partition if name not in columns]
    if outside:
        raise ValueError(f"partition columns that are not landed: {outside}")
    if set(columns) <= set(partition):
        raise ValueError("a landing zone needs a column that is not a partition column")


def write_landing(
    df: DataFrame,
    destination: str,
    columns: Sequence[str],
    partition: Sequence[str] = TIME_PARTITIONS,
    mode: str = "append",
    rebalance: bool = True,
    batch: str | None = None,
) -> None:
    """Write the columns as Parquet, partitioned.

    ``rebalance`` brings the rows of a partition together before the write so
    that it gets few, well-sized files; adaptive execution splits a partition
    that is larger than a task should be, down to the case where all rows share
    one. Turn it off where every task already writes one partition.

    With ``batch`` each partition gets a directory ``batch=<batch>``, and only
    directories of that batch are replaced.
    """
    _check_columns(df, columns, partition)
    rows = df.select(*columns)
    if rebalance:
        rows = rows.hint("rebalance", *partition)
    # Static: an overwrite replaces the destination, whatever the session's default.
    kind = "static"
    if batch is not None:
        rows, partition = rows.withColumn(BATCH, F.lit(batch)), (*partition, BATCH)
        mode, kind = "overwrite", "dynamic"
    writer = rows.write.mode(mode).option("partitionOverwriteMode", kind)
    writer.option("compression", "snappy").partitionBy(*partition).parquet(destination)


def fan_out(
    df: DataFrame, routes: Sequence[Route], mode: str = "append", batch: str | None = None
) -> None:
    """Write the same rows to several destinations, computing them once.

    With more than one route the rows are first written to the shared scratch
    folder, which a lost executor does not take along.
    """
    stage = None
    if len(routes) > 1:
        spark, schema = df.sparkSession, df.schema
        stage = new_folder(spark, "fan-out")
        df.write.parquet(stage)
        df = spark.read.schema(schema).parquet(stage)
    try:
        for route in routes:
            rows = df if route.where is None else df.filter(route.where)
            write_landing(
                rows, route.destination, route.columns, route.partition, mode, route.rebalance, batch
            )
    finally:
        if stage is not None:
            remove(df.sparkSession, stage)


def _attempt(route: Route, batch: str) -> str:
    """Marker of a batch that may have been written before."""
    return f"{route.destination}/_attempts/{batch}"


def _begin(spark: SparkSession, route: Route, batch: str) -> None:
    """Removes what an earlier attempt of the batch left, wherever its rows went.

    The marker tells a first attempt from a replay, so only a replay lists the
    zone.
    """
    marker, files = file_system(spark, _attempt(route, batch))
    if files.exists(marker):
        levels = "*/" * len(route.partition)
        leaves, _ = file_system(spark, f"{route.destination}/{levels}{BATCH}={batch}")
        for leaf in files.globStatus(leaves) or ():
            files.delete(leaf.getPath(), True)
            if route.table:  # the table knows the partition already
                files.mkdirs(leaf.getPath())
    else:
        files.create(marker, True).close()


def _done(spark: SparkSession, route: Route, batch: str) -> None:
    marker, files = file_system(spark, _attempt(route, batch))
    files.delete(marker, False)


def land(df: DataFrame, routes: Sequence[Route], batch: str) -> None:
    """Land the rows as one batch; the same batch again replaces what it landed."""
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"not usable as a directory name: {batch!r}")
    for route in routes:
        _begin(df.sparkSession, route, batch)
    fan_out(df, routes, batch=batch)
    for route in routes:
        if route.table:
            rows = df if route.where is None else df.filter(route.where)
            register_landed(rows, route, batch)


def landing_batches(
    df: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    routes: Sequence[Route],
    checkpoint: str,
    trigger: Trigger,
    run_id: str | None = None,
) -> StreamingQuery:
    """Transform and land every micro-batch, each exactly once.

    A micro-batch owns the directories ``batch=<run>-<n>`` inside the partitions
    of every route and replaces them, so a replay leaves no second copy even when
    its rows fall into other partitions than before. ``run_id`` defaults to the
    id of the stream, which lives in the checkpoint: another checkpoint counts
    its batches from zero again and must not replace the first one's.
    """

    stores = avro.BatchStores()

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run:
            raise ValueError("the stream has no id in this session: pass run_id")
        with stores.batch():
            land(transform(batch), routes, f"{run}-{batch_id}")
        # That this batch runs says that the one before it was committed.
        for route in routes:
            _done(spark, route, f"{run}-{batch_id - 1}")

    writer = df.writeStream.outputMode("append").trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(land_batch).start()


def landing_stream(
    df: DataFrame,
    destination: str,
    columns: Sequence[str],
    checkpoint: str,
    trigger: Trigger,
    partition: Sequence[str] = TIME_PARTITIONS,
) -> StreamingQuery:
    """Land a stream through Spark's own file sink, whose log makes it exactly-once.

    No shuffle: the time partitions are constant within a micro-batch.
    """
    _check_columns(df, columns, partition)
    writer = df.select(*columns).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", destination).partitionBy(*partition).trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def table_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    trigger: Trigger,
    columns: Sequence[str] | None = None,
) -> StreamingQuery:
    """Append a stream to an existing catalog table, cast to its columns.

    The table's own provider stores the rows.
    """
    spark = df.sparkSession
    aligned = align.align_to_table(df, align.table_columns(spark, table), columns)
    writer = aligned.writeStream.outputMode("append").trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).toTable(align.qualified(spark, table))


def message_stream(
    df: DataFrame,
    checkpoint: str,
    trigger: Trigger,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Publish ``topic``, ``key`` and ``value`` of a stream."""
    writer = df.select("topic", "key", "value").writeStream.format(fmt).outputMode("append")
    writer = writer.options(**(options or {})).trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


# Why a message could not be made; such rows are dead letters.
ENCODE_ERROR = "encode_error"


def message_batches(
    df: DataFrame,
    columns: Sequence[str],
    checkpoint: str,
    trigger: Trigger,
    dead_letters: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    run_id: str | None = None,
) -> StreamingQuery:
    """Publish the rows whose ``encode_error`` is null, set the others aside.

    A dead letter keeps ``columns`` and its error. Both outputs belong to the batch: dead
    letters, and messages of a file format with a ``path``, go to ``batch=<run>-<n>``,
    which a replay replaces. A message broker gets a replayed batch's messages again,
    as with any at-least-once producer. The batch is encoded once, to shared storage.
    """
    options = dict(options or {})

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run:
            raise ValueError("the stream has no id in this session: pass run_id")
        stage = new_folder(spark, "messages")
        batch.write.parquet(stage)
        rows = spark.read.schema(batch.schema).parquet(stage)
        owned = f"{BATCH}={run}-{batch_id}"
        lost = rows.where(F.col(ENCODE_ERROR).isNotNull()).select(*columns, ENCODE_ERROR)
        lost.write.mode("overwrite").parquet(f"{dead_letters}/{owned}")
        sent = rows.where(F.col(ENCODE_ERROR).isNull()).select("topic", "key", "value")
        if "path" in options:
            place = options | {"path": f"{options['path']}/{owned}"}
            sent.write.format(fmt).options(**place).mode("overwrite").save()
        else:
            sent.write.format(fmt).options(**options).save()
        remove(spark, stage)

    wanted = dict.fromkeys([*columns, "topic", "key", "value", ENCODE_ERROR])
    writer = df.select(*wanted).writeStream.outputMode("append").trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).foreachBatch(publish).start()


def read_landing(
    spark: SparkSession, path: str, schema: StructType | str, batches: bool = False
) -> DataFrame:
    """Read a landing zone with declared types; ``batches`` for per-batch directories.

    The types are declared because inference would make the two-digit month a
    number.
    """
    extra = f", {BATCH} string" if batches else ""
    ddl = schema if isinstance(schema, str) else _ddl(schema)
    return spark.read.schema(ddl + extra).parquet(path)


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _layout(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a zone, outermost first, by its first directories."""
    names = []
    where, files = file_system(spark, path)
    while files.exists(where):
        inner = [x.getPath() for x in files.listStatus(where) if x.isDirectory() and "=" in x.getPath().getName()]
        if not inner:
            break
        where = inner[0]
        names.append(where.getName().split("=", 1)[0])
    return names


def register_landing(
    spark: SparkSession,
    table: str,
    path: str,
    schema: StructType,
    partition: Sequence[str] = TIME_PARTITIONS,
    discover: bool = True,
) -> None:
    """Create an external table over a landing zone and find its partitions.

    A zone that was written batch by batch gets ``batch`` as a further partition
    column. A zone laid out by other columns than ``partition`` is refused, as
    its rows would not be found.

    Set ``discover`` to False over a zone written by :func:`landing_stream`:
    its file log already tells Spark what to read.
    """
    ddl, found = _ddl(schema), _layout(spark, path)
    if found == [*partition, BATCH]:
        partition = found
        if BATCH not in schema.names:
            ddl += f", {BATCH} string"
    elif found and found != [*partition]:
        raise ValueError(f"the zone {path} is laid out by {found}, not by {[*partition]}")
    _create_table(spark, table, path, ddl, partition)
    if partition and discover:
        spark.sql(f"MSCK REPAIR TABLE {_quoted(table)}")


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _create_table(spark: SparkSession, table: str, path: str, ddl: str, partition: Sequence[str]) -> None:
    location = path.replace("'", "\\'")
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partition)})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({ddl}) USING parquet {by} LOCATION '{location}'")


# Partitions that one statement adds.
ADDED_AT_ONCE = 200


def register_landed(df: DataFrame, route: Route, batch: str | None = None) -> int:
    """Add the partitions of landed rows to the route's table; the number of partitions.

    They are taken from the rows, whose partition columns alone are computed, so neither
    the zone nor the table's earlier partitions are listed. The table is created with the
    columns of the route on first use. Rows and ``batch`` are those handed to :func:`land`;
    partitions that the table has are left as they are. Null and empty text are the zone's
    default partition.
    """
    if route.table is None:
        raise ValueError(f"the route to {route.destination} has no table")
    if not route.partition:
        raise ValueError("a zone without partitions has nothing to add")
    _check_columns(df, route.columns, route.partition)
    spark, partition, ddl = df.sparkSession, [*route.partition], _ddl(df.select(*route.columns).schema)
    values = {c: F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in partition}
    rows = df.select(*(v.alias(c) for c, v in values.items())).distinct()
    if batch is not None:
        rows, partition, ddl = rows.withColumn(BATCH, F.lit(batch)), [*partition, BATCH], f"{ddl}, {BATCH} string"
    _create_table(spark, route.table, route.destination, ddl, partition)
    specs, count = [], 0
    # One row per partition of the batch, a part at a time.
    for row in rows.toLocalIterator():
        specs.append(f"PARTITION ({', '.join(f'`{c}` = {_literal(row[c])}' for c in partition)})")
        count += 1
        if len(specs) == ADDED_AT_ONCE:
            _add(spark, route.table, specs)
            specs = []
    if specs:
        _add(spark, route.table, specs)
    return count


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _add(spark: SparkSession, table: str, specs: list[str]) -> None:
    spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS {' '.join(specs)}")
