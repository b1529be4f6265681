"""Packing documents into sequences: dominance reduction, then best fit.

Only the number of pieces of each length decides about the packing, so the plan
is made from that histogram, which has ``capacity`` entries however many
documents there are, and says how many sequences have which lengths. Pieces then
take their places by their rank among pieces of equal length.

``reduce_lengths`` is the reduction of Martello and Toth on counts: the longest
piece is fixed together with a set of one, two or three that dominates every
other set it could share a sequence with. What is left is packed by best fit,
longest first, on counts again: equal sequences are one entry.

Nulls: a null text is empty and is its end id alone. A null ``doc_id`` stays
null. Repeated rows are packed each. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.store import stored
from eventlake.llm.subwords import encoded
from eventlake.llm.worker import give_back

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part long, rank_in_part long"
)

# A sequence as lengths with their numbers, longest first.
Pattern = tuple[tuple[int, int], ...]


# ------------------------------------------------------------ plan


def _best_pair(sizes: list[int], left: Counter, room: int) -> tuple[int, int]:
    """The two lengths that fill the room best together; zeros if none fit."""
    best, low, high = (0, 0), 0, len(sizes) - 1
    while low <= high:
        total = sizes[low] + sizes[high]
        if total > room:
            high -= 1
            continue
        if (low < high or left[sizes[low]] > 1) and total > sum(best):
            best = (sizes[high], sizes[low])
        low += 1
    return best


def _dominating(size: int, sizes: list[int], left: Counter, capacity: int) -> tuple[int, ...] | None:
    """The set that dominates all others with this length, without it; None if there is none.

    ``left`` does not count the piece itself. ``sizes`` ascend and are in ``left``.
    """
    room = capacity - size
    at = bisect_right(sizes, room)
    if not at:
        return ()
    one = sizes[at - 1]
    least = sizes[0] * 2 if left[sizes[0]] > 1 else sizes[0] + (sizes[1] if len(sizes) > 1 else capacity)
    if one == room or least > room:
        return (one,)
    smallest = []
    for x in sizes[:3]:
        smallest += [x] * min(3, left[x])
    if len(smallest) > 2 and sum(smallest[:3]) <= room:
        return None
    pair = _best_pair(sizes[:at], left, room)
    if one >= sum(pair):
        return (one,)
    if sum(pair) == room and (one - pair[0] < sizes[0] or one - pair[1] < sizes[0]):
        return pair
    return None


def reduce_lengths(left: Counter, capacity: int) -> list[tuple[Pattern, int]]:
    """Takes dominating sets out of ``left`` until there are none; returns them with their numbers."""
    fixed: Counter = Counter()
    changed = True
    while changed:
        changed = False
        for size in sorted(left, reverse=True):
            while left[size]:
                left[size] -= 1
                sizes = sorted(x for x, n in left.items() if n)
                found = _dominating(size, sizes, left, capacity)
                left[size] += 1
                if found is None:
                    break
                need = Counter((size, *found))
                times = min(left[x] // n for x, n in need.items())
                # With equal lengths the piece may be its own partner: once at least.
                times = max(1, times)
                for x, n in need.items():
                    left[x] -= n * times
                fixed[tuple(sorted(need.items(), reverse=True))] += times
                changed = True
        left += Counter()
    return list(fixed.items())


def best_fit(left: Counter, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first. A piece goes where the least room stays; groups of equal sequences move together."""
    rooms: dict[int, list[tuple[Pattern, int]]] = {}

    def put(pattern: Pattern, size: int, count: int, room: int, times: int) -> None:
        rooms.setdefault(room - size * count, []).append((((*pattern, (size, count))), times))

    for size in sorted(left, reverse=True):
        count = left[size]
        for room in sorted(r for r in rooms if r >= size):
            if not count:
                break
            each = room // size
            for pattern, times in rooms.pop(room):
                full = min(times, count // each)
                count -= full * each
                rest = times - full
                if full:
                    put(pattern, size, each, room, full)
                if rest and count:
                    put(pattern, size, count, room, 1)
                    rest, count = rest - 1, 0
                if rest:
                    rooms.setdefault(room, []).append((pattern, rest))
        each = capacity // size
        if count >= each:
            put((), size, each, capacity, count // each)
        if count % each:
            put((), size, count % each, capacity, 1)
    return [entry for group in rooms.values() for entry in group]


def plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, per sequence, first sequence, offset in it) of every entry.

    Pieces of one length with ranks from first to end fill sequences from the
    first on, so many in each.
    """
    left = Counter(lengths)
    patterns = reduce_lengths(left, capacity) + best_fit(left, capacity)
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for size, count in pattern:
            rows.append((size, ranks[size], ranks[size] + count * times, count, sequence, offset))
            ranks[size] += count * times
            offset += size * count
        sequence += times
    return rows


# ------------------------------------------------------------ pieces


def _pieces(path: str, spaces: bool, end_id: int, capacity: int, batches) -> Iterator[pa.RecordBatch]:
    """Rows of ``PIECES``: documents beyond the capacity are cut into full pieces and a rest."""
    part = TaskContext.get().partitionId()
    ranks: Counter = Counter()
    names = [c.split()[0] for c in PIECES.split(", ")]
    kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECES.split(", ")]
    for batch in batches:
        for docs, width, texts in encoded(path, spaces, batch):
            rows = []
            for doc_id, ids in zip(docs.column("doc_id").to_pylist(), texts):
                ids = np.append(np.frombuffer(ids, dtype=f"<u{width}").astype("<u4"), np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    cut = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(cut), zlib.crc32(cut.tobytes()), part, ranks[len(cut)]))
                    ranks[len(cut)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)
            give_back()


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, spaces: bool = False, end_id: int = 0
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(docs.mapInArrow(partial(_pieces, path, spaces, end_id, capacity), PIECES), "pieces")
    in_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    lengths = {r["length"]: r["n"] for r in in_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    columns = "length long, low long, high long, per_sequence long, first_sequence long, first_offset long"
    slots = docs.sparkSession.createDataFrame(plan(lengths, capacity), columns)
    earlier = F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = in_part.select("part", "length", F.coalesce(earlier, F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("rank_in_part"))
    # The plan has a few entries per length: its size does not depend on the data's.
    placed = ranked.join(F.broadcast(slots), "length").where("rank >= low and rank < high")
    at = F.col("rank") - F.col("low")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.expr("(rank - low) div per_sequence")).alias("sequence_id"),
        (F.col("first_offset") + F.col("length") * (at % F.col("per_sequence"))).alias("offset"),
    )
