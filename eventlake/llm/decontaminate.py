"""Benchmark decontamination by template canonicalisation.

A text becomes a template: numbers, names and units turn into typed placeholders,
other words are lower-cased. Windows of ``WINDOW`` template tokens of benchmark
items are joined by hash with those of the documents, so a question asked again
with other numbers or names still meets its original. Then slots are checked:
along one alignment of document and item, each value of the item must stand for
one value of the document everywhere.

Tokens are runs of letters and digits. A token with a digit or a number word is a
number; one of ``UNITS`` after a number is a unit; a capitalised word that does
not begin a sentence, and is not in capitals throughout, is a name. Neighbouring
numbers, and neighbouring names, are one.

A window needs literal words for at least half of its tokens. An item of fewer
tokens than a window is one window of its own length, and is found where it is a whole
sentence, or stands with its own values. An item without such a window is not found.

Only windows that pass a bitmap of the items' hashes, which has a fixed size,
leave a document's task.

Nulls: null texts are empty, on both sides. Rows of a null ``doc_id`` or
``item_id`` are documents or items under that null. Rows of one id count as one
document. An empty table on either side gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import words
from eventlake.llm.store import stored, without
from eventlake.llm.worker import give_back, kept

WINDOW = 8
# Bits of the map of window hashes.
MAP_BITS = 1 << 22

# Words for numbers.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion"
).split()
# Words for units.
UNITS = (
    "mm cm m km meter meters metre metres kilometer kilometers kilometre kilometres inch inches foot feet "
    "yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons tonne tonnes "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years mph kph percent degree degrees dollar dollars cent cents euro euros "
    "watt watts volt volts joule joules newton newtons"
).split()

LITERAL, NUMBER, NAME, UNIT = range(4)

BETWEEN = words.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
# What ends a sentence.
ENDS = b".!?:;|\n\""

HITS = "doc_id long, position long, hash long, whole boolean, slots array<string>"


def _word_set(entries: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(entries).encode(), np.uint8)
    return np.sort(words.word_hashes(data, np.array([0, len(data)]), BETWEEN)[0])


def _lexicon() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.zeros(256, dtype=np.int32)
    ends[list(ENDS)] = 1
    digits = np.zeros(256, dtype=np.int32)
    digits[ord("0") : ord("9") + 1] = 1
    return _word_set(NUMBERS), _word_set(UNITS), ends, digits


def templates(data: np.ndarray, offsets: np.ndarray):
    """Template tokens of a slice of texts: hash, kind, first byte, end byte, bounds per row, and if a sentence begins."""
    numbers, units, ends_table, digits_table = kept("lexicon", _lexicon)
    hashes, bounds, starts, ends = words.word_hashes(data, offsets, BETWEEN)
    count = len(hashes)
    first_of_row = np.zeros(count + 1, dtype=bool)
    first_of_row[bounds] = True
    first_of_row = first_of_row[:count]
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    head, second = padded[starts], padded[starts + 1]
    digits = np.concatenate([[0], np.cumsum(digits_table[data])])
    stops = np.concatenate([[0], np.cumsum(ends_table[data])])
    before = np.concatenate([[0], ends[:-1]]) if count else ends
    begins = first_of_row | (stops[starts] > stops[before])
    capital = (head >= 65) & (head <= 90) | (head == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    shouted = (second >= 65) & (second <= 90)
    kinds = np.full(count, LITERAL, dtype=np.int8)
    kinds[capital & ~shouted & ~begins] = NAME
    kinds[(digits[ends] > digits[starts]) | np.isin(hashes, numbers)] = NUMBER
    after_number = np.zeros(count, dtype=bool)
    after_number[1:] = (kinds[:-1] == NUMBER) & ~first_of_row[1:]
    kinds[after_number & np.isin(hashes, units)] = UNIT
    joined = np.zeros(count, dtype=bool)
    joined[1:] = (kinds[1:] == kinds[:-1]) & ((kinds[1:] == NUMBER) | (kinds[1:] == NAME)) & ~first_of_row[1:]
    keep = np.flatnonzero(~joined)
    last = np.append(keep[1:], count) - 1
    tokens = np.where(kinds[keep] == LITERAL, hashes[keep], kinds[keep].astype(np.uint64))
    bounds = np.searchsorted(keep, bounds)
    return tokens, kinds[keep], starts[keep], ends[last] if count else ends, bounds, np.append(begins[keep], True)


def windows(tokens: np.ndarray, kinds: np.ndarray, bounds: np.ndarray, width: int):
    """(first tokens, hashes) of all windows with enough literal words."""
    count = len(tokens) - width + 1
    if count < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    mixed = words.mix(tokens + np.uint64(1))
    value = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        value = value * np.uint64(0x9E3779B97F4A7C15) + mixed[k : k + count]
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
    good = (row[:count] == row[width - 1 :]) & (2 * (literal[width:] - literal[:count]) >= width)
    at = np.flatnonzero(good)
    return at, words.mix(value[at])


def _slots(data: np.ndarray, kinds, starts, ends, first: int, width: int) -> list[str]:
    """Values of a window's placeholders, with their kind, in order."""
    return [
        f"{kinds[t]}:" + data[starts[t] : ends[t]].tobytes().decode("utf-8", "replace").lower()
        for t in range(first, first + width)
        if kinds[t] != LITERAL
    ]


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, position, width, hash, slots, item_windows) of every window of every item."""
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        out = []
        for row, data, offsets in words.slices(batch.column("text")):
            tokens, kinds, starts, ends, bounds, _ = templates(data, offsets)
            for r in range(len(offsets) - 1):
                low, high = bounds[r], bounds[r + 1]
                width = min(WINDOW, int(high - low))
                if not width:
                    continue
                at, hashes = windows(tokens[low:high], kinds[low:high], np.array([0, high - low]), width)
                for first, value in zip(at.tolist(), hashes.view(np.int64).tolist()):
                    slots = _slots(data, kinds, starts, ends, int(low) + first, width)
                    out.append((ids[row + r], first, width, value, slots, len(at)))
        if out:
            names = ["item_id", "item_position", "width", "hash", "item_slots", "item_windows"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _hits(bitmap: bytes, widths: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``HITS``: windows of documents whose hash is on the map."""
    bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        out = []
        for row, data, offsets in words.slices(batch.column("text")):
            tokens, kinds, starts, ends, bounds, begins = templates(data, offsets)
            for width in widths:
                at, hashes = windows(tokens, kinds, bounds, width)
                on = bits[(hashes & np.uint64(MAP_BITS - 1)).astype(np.int64)]
                at, hashes = at[on], hashes[on].view(np.int64)
                rows = np.searchsorted(bounds, at, side="right") - 1
                whole = begins[at] & begins[at + width] if width < WINDOW else np.ones(len(at), dtype=bool)
                for r, first, value, alone in zip(rows.tolist(), at.tolist(), hashes.tolist(), whole.tolist()):
                    slots = _slots(data, kinds, starts, ends, first, width)
                    out.append((ids[row + r], first - int(bounds[r]), value, alone, slots))
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.string())]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "position", "hash", "whole", "slots"])
        give_back()


def leaks(docs: DataFrame, benchmark: DataFrame, min_coverage: float = 0.5) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, coverage, kind) of documents that hold a benchmark item.

    Coverage is the share of the item's windows found with consistent slots; kind
    is ``verbatim`` when all slots have the item's own values, else
    ``reparameterised``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    schema = "item_id long, item_position long, width int, hash long, item_slots array<string>, item_windows long"
    indexed = stored(items.mapInArrow(_item_windows, schema), "item-windows")
    place = f"(hash & {MAP_BITS - 1}L)"
    lanes = indexed.selectExpr(f"shiftright({place}, 5) AS lane", f"shiftleft(1L, cast({place} & 31L AS int)) AS bit")
    bitmap = np.zeros(MAP_BITS // 32, dtype="<u4")
    # The map's words, not the items': at most MAP_BITS / 32 rows.
    for lane, bits in lanes.groupBy("lane").agg(F.bit_or("bit")).collect():
        bitmap[lane] = bits
    widths = [r["width"] for r in indexed.select("width").distinct().collect()]
    hits = docs.mapInArrow(partial(_hits, bitmap.tobytes(), sorted(widths)), HITS)
    found = hits.join(indexed, "hash").where("size(slots) = size(item_slots) and (whole or slots = item_slots)")
    key = ["doc_id", "item_id", "shift"]
    found = stored(
        found.select(
            "doc_id",
            "item_id",
            (F.col("position") - F.col("item_position")).alias("shift"),
            "item_position",
            "item_windows",
            F.arrays_zip("item_slots", "slots").alias("pairs"),
        ),
        "window-hits",
    )
    values = found.select(*key, F.explode("pairs").alias("p")).select(*key, "p.*")
    values = values.groupBy(*key, "item_slots").agg(F.min("slots").alias("low"), F.max("slots").alias("high"))
    slots = values.groupBy(*key).agg(
        F.bool_and(F.col("low") == F.col("high")).alias("consistent"),
        F.bool_and((F.col("low") == F.col("item_slots")) & (F.col("high") == F.col("item_slots"))).alias("own"),
    )
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key]
    spans = found.drop("pairs").distinct().alias("w").join(slots.alias("s"), same, "left").where(
        "consistent is null or consistent"
    )
    per_item = spans.groupBy("w.doc_id", "w.item_id").agg(
        F.count_distinct("item_position").alias("windows"),
        F.max("item_windows").alias("item_windows"),
        F.bool_and(F.coalesce("own", F.lit(True))).alias("own"),
    )
    coverage = F.col("windows") / F.col("item_windows")
    return per_item.where(coverage >= min_coverage).select(
        "doc_id",
        "item_id",
        "windows",
        "item_windows",
        coverage.alias("coverage"),
        F.when(F.col("own"), "verbatim").otherwise("reparameterised").alias("kind"),
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, min_coverage: float = 0.5) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the rows that hold a benchmark item.

    A row is known by 64 bits of its id and text: another text of the same id stays, and rows
    of a null id are judged one by one.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = leaks(docs.select(row.alias("doc_id"), "text"), benchmark, min_coverage)
    return without(docs, found.select("doc_id"), row)
