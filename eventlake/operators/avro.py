"""Table-wide decode and encode of framed Avro payloads."""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from eventlake.functions.avro_read import Cursors, Reader, read_rows, text_reader
from eventlake.functions.avro_write import writer
from eventlake.functions.digest import payload_base64
from eventlake.functions.envelope import HEADER_BYTES
from eventlake.functions.payload import split_paths
from eventlake.operators import registry
from eventlake.scratch import new_folder

# What is wrong with a frame. The first three keep the marker value in
# ``events``; a frame with an unexpected magic byte is still decoded.
SHORT_FRAME = "short_frame"
UNKNOWN_SCHEMA = "unknown_schema"
BAD_BODY = "bad_body"
BAD_MAGIC = "bad_magic"

DECODED = pa.struct([("json", pa.string()), ("error", pa.string())])
DECODED_DDL = "json string, error string"


def compiled(body: str | None, drop: tuple[tuple[str, ...], ...]) -> Reader | None:
    """Reader of a schema document, or None where there is no usable one."""
    try:
        return text_reader(json.loads(body), drop)
    except (ValueError, LookupError, TypeError, AttributeError, RecursionError):
        return None


def decode_batch(
    payloads: pa.Array,
    codes: np.ndarray,
    read_of: Callable[[int], Reader | None],
) -> pa.Array:
    """Decode one Arrow batch; rows with the same code share a reader."""
    texts = np.full(len(payloads), None, object)
    errors = np.full(len(payloads), None, object)
    cursors = Cursors(payloads, HEADER_BYTES)
    present = payloads.is_valid().to_numpy(zero_copy_only=False)
    short = present & (cursors.end - cursors.start < HEADER_BYTES)
    errors[short] = SHORT_FRAME
    for code in np.unique(codes[present & ~short]).tolist():
        rows = np.flatnonzero(present & ~short & (codes == code))
        read = read_of(code)
        if read is None:
            errors[rows] = UNKNOWN_SCHEMA
            continue
        texts[rows] = read_rows(read, cursors, rows)
        failed = rows[cursors.bad[rows]]
        texts[failed], errors[failed] = None, BAD_BODY
    return pa.StructArray.from_arrays(
        [pa.array(texts, pa.string()), pa.array(errors, pa.string())], fields=list(DECODED)
    )


def frame_ids(payloads: pa.Array) -> np.ndarray:
    """Big-endian schema id of every frame, -1 where there is none."""
    cursors = Cursors(payloads, 0)
    last = len(cursors.data)
    at = np.minimum(cursors.start[:, None] + np.arange(1, HEADER_BYTES), last)
    ids = cursors.bytes[at].view(">u4").ravel().astype(np.int64)
    return np.where(cursors.end - cursors.start < HEADER_BYTES, -1, ids)


# Schema stores on the executors that no stream owns, by application and content. Frames
# decode lazily, so these stay: any frame made with one may still be run.
_SHARED: dict[tuple[str, str], Broadcast] = {}
_SHARED_LOCK = threading.Lock()
_OWNER = threading.local()


class BatchStores:
    """The schema stores of a stream, each for as long as its batches use it.

    PySpark keeps a file on the driver for each broadcast. A store that a batch did
    not use any more is destroyed when the batch is through, so a stream holds the
    stores of one batch, however many versions it has seen.
    """

    def __init__(self):
        self.held: dict[tuple[str, str], Broadcast] = {}
        self.used: set[tuple[str, str]] = set()

    @contextmanager
    def batch(self):
        """Within, this thread's stores belong to the batch; its frames must be run within, too."""
        before = getattr(_OWNER, "stores", None)
        _OWNER.stores, self.used = self, set()
        try:
            yield
        finally:
            _OWNER.stores = before
            for key in self.held.keys() - self.used:
                self.held.pop(key).destroy()


def _shared(spark: SparkSession, bodies: dict[str, str]) -> Broadcast:
    """The store as a broadcast, the same one as long as its content stays.

    A stream decodes every micro-batch with the store of that moment, which
    rarely changes.
    """
    context = spark.sparkContext
    content = json.dumps(bodies, sort_keys=True).encode()
    key = (context.applicationId, hashlib.sha256(content).hexdigest())
    owner = getattr(_OWNER, "stores", None)
    with _SHARED_LOCK:
        held = _SHARED if owner is None else owner.held
        for other in [k for k in held if k[0] != context.applicationId]:
            del held[other]
        if key not in held:
            held[key] = context.broadcast(bodies)
        if owner is not None:
            owner.used.add(key)
        return held[key]


def _decoded_by_map(
    df: DataFrame, bodies: dict[str, str], drop: tuple[tuple[str, ...], ...]
) -> Column:
    shared = _shared(df.sparkSession, bodies)
    readers: dict[int, Reader | None] = {}

    def read_of(schema_id: int) -> Reader | None:
        # Kept for the batches of a task.
        if schema_id not in readers:
            readers[schema_id] = compiled(shared.value.get(str(schema_id)), drop)
        return readers[schema_id]

    @F.arrow_udf(DECODED_DDL)
    def decode_frames(payloads: pa.Array) -> pa.Array:
        return decode_batch(payloads, frame_ids(payloads), read_of)

    return decode_frames(F.col("value"))


def _decoded_by_body(drop: tuple[tuple[str, ...], ...]) -> Column:
    @F.arrow_udf(DECODED_DDL)
    def decode_frames(payloads: pa.Array, bodies: pa.Array) -> pa.Array:
        encoded = bodies.dictionary_encode()
        texts = encoded.dictionary.to_pylist()
        codes = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        return decode_batch(
            payloads, codes, lambda code: compiled(texts[code] if code >= 0 else None, drop)
        )

    return decode_frames(F.col("value"), F.col("schema_body"))


# Bytes of frames, and rows, that are decoded as one group; an id beyond is dealt over several.
GROUP_BYTES = 32 << 20
GROUP_ROWS = 1 << 19

# Ids of more than one group that are few enough to be broadcast.
MAX_HOT_IDS = 500_000

# Rows that are decoded at once within a group.
STEP_ROWS = 10_000


def _decoded_by_cogroup(
    df: DataFrame,
    schemas: DataFrame | registry.SchemaTable,
    drop: tuple[tuple[str, ...], ...],
    max_schema_bytes: int,
    group_bytes: int,
    group_rows: int,
) -> DataFrame:
    """The rows with ``decoded``, each schema document meeting the frames of its id once a group.

    The rows are written to the shared scratch folder, so their source is read once.
    From there the ids alone are read to measure how much each holds; an id beyond the
    size of a group, null among them, is dealt over as many groups as it needs, and its
    document is copied to each of these. Rows are shuffled once, without documents; not
    at all where the documents of these ids alone are small enough to be broadcast.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "frames")
    ident = F.coalesce("kafka_metadata_schemaid", F.lit(""))
    df.withColumn("_id", ident).write.parquet(folder)
    rows = spark.read.parquet(folder)
    groups = F.ceil(F.greatest(F.sum(F.octet_length("value")) / group_bytes, F.count("*") / group_rows, F.lit(1)))
    sizes = rows.groupBy("_id").agg(groups.cast("int").alias("_groups"))
    sizes.write.parquet(f"{folder}-sizes")
    sizes = spark.read.parquet(f"{folder}-sizes")

    ids = sizes.select(F.col("_id").alias("schema_id"))
    if isinstance(schemas, registry.SchemaTable):
        schemas = used = schemas.needed(ids)
    else:
        used = schemas.join(ids, "schema_id", "left_semi")
    small = registry.schema_map(used, max_schema_bytes)
    if small is not None:
        return rows.select(*df.columns).withColumn("decoded", _decoded_by_map(df, small, drop))

    hot = sizes.where("_groups > 1")
    hot = F.broadcast(hot) if hot.count() <= MAX_HOT_IDS else hot
    # The row's number in the written table: the same on every attempt, and even over the groups.
    dealt = F.pmod(F.monotonically_increasing_id(), F.coalesce("_groups", F.lit(1)))
    rows = rows.join(hot, "_id", "left").withColumn("_group", dealt.cast("int")).drop("_groups")
    bodies = schemas.select(F.col("schema_id").alias("_id"), "body").groupBy("_id").agg(F.min("body").alias("body"))
    bodies = bodies.join(sizes, "_id").select(
        "_id", "body", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_group")
    )
    names = df.columns
    schema = StructType([*df.schema.fields, StructField("decoded", StructType.fromDDL(DECODED_DDL))])

    def decode_group(frames: pa.Table, documents: pa.Table) -> pa.Table:
        frames = frames.select(names)
        body = documents["body"][0].as_py() if len(documents) else None
        read = compiled(body, drop)
        parts = []
        for at in range(0, max(len(frames), 1), STEP_ROWS):
            payloads = frames["value"].slice(at, STEP_ROWS).combine_chunks()
            payloads = payloads if isinstance(payloads, pa.Array) else pa.concat_arrays(payloads.chunks)
            parts.append(decode_batch(payloads, np.zeros(len(payloads), np.int64), lambda _: read))
        frames = frames.append_column("decoded", pa.chunked_array(parts, type=DECODED))
        # Cogrouped functions hand back Spark's plain types, also where a session reads wide ones.
        return frames.cast(pa.schema([(field.name, to_arrow_type(field.dataType)) for field in schema]))

    keys = ("_id", "_group")
    return rows.groupBy(*keys).cogroup(bodies.groupBy(*keys)).applyInArrow(decode_group, schema)


def decode_events(
    df: DataFrame,
    schemas: DataFrame | registry.SchemaTable,
    drop: Sequence[str] = (),
    max_schema_bytes: int = registry.MAX_SCHEMA_BYTES,
    group_bytes: int = GROUP_BYTES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add ``events`` and ``decode_error`` to rows that carry a frame in ``value``.

    ``events`` is base64 of the flattened event as JSON text, in schema field
    order and without the dotted ``drop`` paths. A frame that cannot be decoded
    gets the in-band marker ``{"<schema id>": -1}`` and a ``decode_error``; a
    null value gets null in both.

    ``schemas`` has one row (``schema_id``, ``body``) per schema, or is a
    :class:`registry.SchemaTable`, of which bounded rows read only their ids' part. Its size is
    measured first: a store within ``max_schema_bytes`` is broadcast, a larger one is cut
    to the ids that occur in ``df`` and measured again. Beyond that bound the rows are
    grouped by schema id together with the documents, an id of more than
    ``group_bytes`` or ``group_rows`` in several groups. On a stream the documents are
    joined to the rows.
    """
    if "kafka_metadata_schemaid" not in df.columns:
        raise ValueError("decode_events needs the header columns, see envelope.add_header")
    keys = tuple(map(tuple, split_paths(drop)))
    in_table = isinstance(schemas, registry.SchemaTable)
    if in_table and df.isStreaming:
        schemas, in_table = schemas.all(), False
    bodies = None if in_table else registry.schema_map(schemas, max_schema_bytes)
    if bodies is not None:
        df = df.withColumn("decoded", _decoded_by_map(df, bodies, keys))
    elif df.isStreaming:
        joined = registry.attach_schema(df, registry.unique_schemas(schemas))
        df = joined.withColumn("decoded", _decoded_by_body(keys))
    else:
        df = _decoded_by_cogroup(df, schemas, keys, max_schema_bytes, group_bytes, group_rows)

    marker = F.concat(
        F.lit('{"'), F.coalesce("kafka_metadata_schemaid", F.lit("null")), F.lit('": -1}')
    )
    wrong_magic = F.when(F.col("kafka_magic_byte") != "0", F.lit(BAD_MAGIC))
    return df.withColumns(
        {
            "events": F.when(
                F.col("value").isNotNull(),
                payload_base64(F.encode(F.coalesce("decoded.json", marker), "utf-8")),
            ),
            "decode_error": F.coalesce("decoded.error", wrong_magic),
        }
    ).drop("decoded", "schema_body")


# Why a row could not be written.
BAD_VALUE = "bad_value"


def encode_events(
    df: DataFrame, column: str, schema_id: int, schema: str | dict, into: str = "value", error: str | None = None
) -> DataFrame:
    """Frame a struct or map column as Avro: magic byte, schema id, body.

    A row that the schema does not allow (a null in a required field, an unknown symbol)
    fails the job, or, with ``error``, has a null frame and ``bad_value`` in that
    column. A null row has a null frame.
    """
    parsed = json.loads(schema) if isinstance(schema, str) else schema
    header = b"\0" + int(schema_id).to_bytes(HEADER_BYTES - 1, "big")

    @F.arrow_udf("binary")
    def encode_rows(values: pa.Array) -> pa.Array:
        written = writer(parsed)(values.drop_null())
        if error is None and None in written:
            raise ValueError("a row that its schema does not allow: null value for a required field, or unknown symbol")
        bodies = iter(header + body if body is not None else None for body in written)
        return pa.array([next(bodies) if there else None for there in values.is_valid().to_pylist()], pa.binary())

    framed = df.withColumn(into, encode_rows(F.col(column)))
    if error is None:
        return framed
    return framed.withColumn(error, F.when(F.col(column).isNotNull() & F.col(into).isNull(), F.lit(BAD_VALUE)))


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded rows, and the rows to quarantine."""
    failed = F.col("decode_error").isNotNull()
    return df.filter(~failed), df.filter(failed)
