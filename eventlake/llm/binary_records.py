"""Token ids as length-delimited binary records, with an offset index.

Record: length of the payload (u64), masked checksum of those 8 bytes (u32),
payload, masked checksum of the payload (u32), and the end mark ``0A``. Payload:
document id (i64), number of ids (u32), bytes per id (u8, 80 added where the
document id is null), ids. All little-endian; checksums are CRC-32, masked as
``rotate_right(crc, 15) + A282EAD8``.

Shards are written by Spark's text writer, whose line separator is the end mark:
task retries, speculation and commits are Spark's, on any file system. A shard
holds a range of document ids in ascending order and part numbers ascend with the
ranges, so shard after shard the file set is in document order.

Nulls: a null text is empty and has the end id alone; rows of a null ``doc_id``
come first. Repeated ids are kept, ordered by text. An empty table gives no
records and an empty index. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.store import stored
from eventlake.llm.subwords import encoded

# UTF-8 bytes of text per shard, about.
SHARD_BYTES = 32 << 20

HEAD, HEAD_BYTES = "<QI", 12
CHECK, CHECK_BYTES = "<I", 4
PAYLOAD, PAYLOAD_BYTES = "<qIB", 13
NULL_ID = 0x80
END_MARK = b"\n"

INDEX = "shard long, position long, length long, doc_id long, n_tokens long, ids_crc32 long, before long"


class DamagedRecord(ValueError):
    """A record whose lengths or checksums do not hold."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record without its end mark."""
    flags = width | (NULL_ID if doc_id is None else 0)
    payload = struct.pack(PAYLOAD, doc_id or 0, len(ids) // width, flags) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload))))


def unframe(data: memoryview, position: int) -> tuple[int | None, np.ndarray, int]:
    """(document id, ids as u32, position of the next record)."""
    if position + HEAD_BYTES > len(data):
        raise DamagedRecord(f"cut header at {position}")
    length, check = struct.unpack_from(HEAD, data, position)
    if masked(bytes(data[position : position + 8])) != check:
        raise DamagedRecord(f"length at {position}")
    start = position + HEAD_BYTES
    end = start + length
    if end + CHECK_BYTES + 1 > len(data) or data[end + CHECK_BYTES] != END_MARK[0]:
        raise DamagedRecord(f"cut record at {position}")
    if masked(bytes(data[start:end])) != struct.unpack_from(CHECK, data, end)[0]:
        raise DamagedRecord(f"payload at {position}")
    doc_id, count, flags = struct.unpack_from(PAYLOAD, data, start)
    width = flags & ~NULL_ID
    if count * width != length - PAYLOAD_BYTES:
        raise DamagedRecord(f"count at {position}")
    ids = np.frombuffer(data, dtype=f"<u{width}", count=count, offset=start + PAYLOAD_BYTES).astype("<u4")
    return (None if flags & NULL_ID else doc_id), ids, end + CHECK_BYTES + 1


def _frames(path: str, spaces: bool, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, width, ids in encoded(path, spaces, batch):
            end = end_id.to_bytes(width, "little")
            out = [frame(name, x + end, width) for name, x in zip(part.column("doc_id").to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])


def write_records(docs: DataFrame, folder: str, path: str, spaces: bool = True, end_id: int = 0) -> None:
    """Encodes whole texts of ``docs`` (doc_id, text) and writes them in ascending ``doc_id`` order."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = size // SHARD_BYTES + 1
    ordered = docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    frames = ordered.mapInArrow(partial(_frames, path, spaces, end_id), "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", END_MARK.decode()).text(folder)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``INDEX`` from whole shards."""
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            data, position, before = memoryview(content.as_buffer()), 0, 0
            rows = []
            while position < len(data):
                doc_id, ids, after = unframe(data, position)
                rows.append((shard, position, after - position, doc_id, len(ids), zlib.crc32(ids.tobytes()), before))
                position = after
                before += len(ids)
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in INDEX.split(", ")])


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, content) of a record folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    return files.select(number.alias("shard"), "content")


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each record is, by reading all shards once; checks every checksum."""
    return stored(shards(spark, folder).mapInArrow(_records, INDEX), "record-index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all records before each one."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("ids"))
    # One row per shard.
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return index.join(F.broadcast(totals), "shard").withColumn("start", F.col("base") + F.col("before")).drop("base")


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for content, places in zip(batch.column("content"), batch.column("places").to_pylist()):
            data = memoryview(content.as_buffer())
            rows += [unframe(data, position)[:2] for position in places]
        ids = pa.array([x.tolist() for _, x in rows], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), ids], ["doc_id", "ids"])


def read_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the index rows in ``wanted`` (shard, position), which may be in any order."""
    places = wanted.groupBy("shard").agg(F.collect_list("position").alias("places"))
    return shards(spark, folder).join(places, "shard").mapInArrow(_wanted, "doc_id long, ids array<long>")
