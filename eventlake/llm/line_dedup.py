"""Line deduplication by a segment-partition edit join, in DataFrame functions only.

A line is dropped when the same line occurs earlier, or when a line within one
edit (a character replaced, added or left out) first occurs before this line
first does. Earlier means a smaller ``doc_id``, null ids first, then a smaller hash
of the text, then a smaller line number. A row is known by its id and its text: rows
that share an id, or have none, are told apart by their texts, and only rows equal
in both are one document. Blank lines always stay; lines of fewer than ``min_chars``
characters, outer spaces not counted, go only as exact repeats.

1. Equal lines are grouped by 128 bits of their hash.
2. For a threshold of one edit a line has two segments. Of two lines within it,
   the longer begins with the first segment of the shorter or ends with its
   second. The index holds each line's segments under its length, and a line
   probes it at its own length and at one less: four keys per line.
3. A key that many lines share is split again: what is left of the lines beside
   the segment must be within one edit as well, so it is cut into two segments in
   turn, until a key is small or the rest is one character.
4. Pairs under a key are verified by ``within_edits``, a banded bit-parallel edit
   distance.

Nulls: a null text stays null and has no lines. Empty texts have one empty line.
An empty table gives an empty result. Extra columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.store import stored

# Lines under one key beyond which the key is split again.
SPLIT_OVER = 64

LINE = ("h1", "h2")
# A row of the documents: its id and 128 bits of its text's hash.
ROW = ("doc_id", "t1", "t2")

# Lines that are few enough for their hashes to be broadcast.
BROADCAST_LINES = 500_000


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings are within an edit distance, by bits of the band of diagonals.

    Bit e of word d says that the diagonal e - ``edits`` is reached with d edits
    at most. A step reads one character of ``b``, next to those of ``a`` that the
    band holds there, and moves all diagonals at once.
    """
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1).cast("long")
    xs, ys = F.split(a, ""), F.split(b, "")
    gap = F.char_length(a) - F.char_length(b)
    # Character i + e - edits of a beside character i of b; null outside.
    beside = [
        F.concat(F.array_repeat(F.lit(None).cast("string"), edits - e), xs) if e <= edits else F.slice(xs, e - edits + 1, F.char_length(a) + 1)
        for e in range(width)
    ]
    steps = F.arrays_zip(ys.alias("y"), *(x.alias(f"x{e}") for e, x in enumerate(beside)))

    def start(d: int) -> Column:
        # Up to d characters of a may be left out before anything is read.
        return F.lit(sum(1 << (edits + e) for e in range(d + 1))).cast("long").alias(f"r{d}")

    def step(state: Column, at: Column) -> Column:
        y = at.getField("y")
        same = reduce(
            lambda x, z: x.bitwiseOR(z),
            [F.when(at.getField(f"x{e}") == y, 1 << e).otherwise(0).cast("long") for e in range(width)],
        )
        words: list[Column] = []
        for d in range(edits + 1):
            word = state[f"r{d}"].bitwiseAND(same)
            if d:
                before = state[f"r{d - 1}"]
                word = word.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                word = word.bitwiseOR(F.shiftleft(words[-1], 1))
            words.append(word.bitwiseAND(full))
        # Behind the end of b nothing is read any more.
        return F.struct(*(F.when(y.isNull(), state[f"r{d}"]).otherwise(w).alias(f"r{d}") for d, w in enumerate(words)))

    last = F.aggregate(steps, F.struct(*(start(d) for d in range(edits + 1))), step)
    reached = F.getbit(last[f"r{edits}"], F.greatest(F.lit(0), F.least(F.lit(width - 1), gap + edits)))
    return (F.abs(gap) <= edits) & ((F.char_length(b) == 0) | (reached == 1))


def _hashes(text: str, names: tuple[str, str]) -> list[Column]:
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(1), text).alias(names[1])]


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, line_no, line, h1, h2) of every line that may be dropped."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", *_hashes("text", ROW[1:]), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.where(F.col("line").rlike(r"\S"))
    return rows.select("*", *_hashes("line", LINE))


def _position() -> Column:
    """Row and line; nulls sort first."""
    return F.struct(*ROW, "line_no")


def _distinct_lines(lines: DataFrame, min_chars: int) -> DataFrame:
    """One row per line text: hashes, length, segment keys, whether near copies are searched, first position, occurrences."""
    size = F.char_length("line")

    def keys(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [
            F.xxhash64(length, F.lit("begin"), F.left("line", half)),
            F.xxhash64(length, F.lit("end"), F.right("line", length - half)),
        ]

    own, shorter = keys(size), keys(size - 1)
    named = lines.select(
        *LINE,
        size.alias("size"),
        (F.char_length(F.trim("line")) >= min_chars).alias("searched"),
        own[0].alias("k0"),
        own[1].alias("k1"),
        shorter[0].alias("k2"),
        shorter[1].alias("k3"),
        _position().alias("position"),
    )
    grouped = named.groupBy(*LINE, "size", "searched", "k0", "k1", "k2", "k3")
    return stored(grouped.agg(F.min("position").alias("first"), F.count("*").alias("n")), "lines")


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows of keys that pair something, with the number of rows under the key.

    Two lines of a key pair unless both are probes.
    """
    sizes = keyed.groupBy("key").agg(F.count("*").alias("under_key"), F.min("probe").alias("least"))
    return keyed.join(sizes.where("under_key > 1 and least = 0").drop("least"), "key")


def _pairs(keyed: DataFrame) -> DataFrame:
    """Pairs of different lines under a key, as (a1, a2, b1, b2); b is an index row."""
    a = keyed.select("key", F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("probe").alias("a_probe"))
    b = keyed.where("probe = 0").select("key", F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    both = a.join(b, "key").where("a_probe = 1 or (a1, a2) < (b1, b2)").where("(a1, a2) <> (b1, b2)")
    return both.select("a1", "a2", "b1", "b2")


def _split(rows: DataFrame) -> DataFrame:
    """Each row under the two keys of what is left of its line: characters [low, high), ``room`` long in the index."""
    half = F.floor(F.col("room") / 2).cast("int")
    rest = F.col("room") - half

    def part(name: str, at: Column, length: Column, low: Column, high: Column, room: Column) -> Column:
        text = F.substring(F.col("line"), at + 1, length)
        return F.struct(
            F.xxhash64("key", F.lit(name), text).alias("key"),
            low.alias("low"),
            high.alias("high"),
            room.alias("room"),
        )

    low, high = F.col("low"), F.col("high")
    begin = part("begin", low, half, low + half, high, rest)
    end = part("end", high - rest, rest, low, high - rest, half)
    return rows.select(*LINE, "probe", "line", F.explode(F.array(begin, end)).alias("part")).select(
        "part.*", *LINE, "probe", "line"
    )


def _candidates(distinct: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, texts of the lines in them)."""
    half, shorter_half = F.expr("size div 2"), F.expr("(size - 1) div 2")
    size, zero = F.col("size"), F.lit(0)

    def place(key: str, probe: int, low: Column, high: Column, room: Column) -> Column:
        numbers = {"low": low, "high": high, "room": room}
        return F.struct(
            F.col(key).alias("key"), F.lit(probe).alias("probe"), *(c.cast("int").alias(n) for n, c in numbers.items())
        )

    # What is left of a line beside the segment, and its length on the index side.
    places = F.array(
        place("k0", 0, half, size, size - half),
        place("k1", 0, zero, half, half),
        place("k2", 1, shorter_half, size, size - 1 - shorter_half),
        place("k3", 1, zero, shorter_half + 1, shorter_half),
    )
    keyed = distinct.where("searched").select(*LINE, F.explode(places).alias("place")).select(*LINE, "place.*")
    shared = stored(_shared(keyed), "shared-keys")
    wanted = shared.select(*LINE).distinct()
    # Texts are shuffled only where the list of lines is too long to be broadcast.
    few = wanted.count() <= BROADCAST_LINES
    found = lines.join(F.broadcast(wanted) if few else wanted, list(LINE))
    texts = stored(found.groupBy(*LINE).agg(F.first("line").alias("line")), "line-texts")
    pairs = _pairs(shared.where(F.col("under_key") <= SPLIT_OVER))
    large = shared.where(F.col("under_key") > SPLIT_OVER).drop("under_key")
    if not large.isEmpty():
        large = large.join(texts, list(LINE))
        while True:
            again = stored(_shared(_split(large)), "split-keys")
            done = (F.col("under_key") <= SPLIT_OVER) | (F.col("room") <= 1)
            pairs = pairs.unionByName(_pairs(again.where(done)))
            large = again.where(~done).drop("under_key")
            if large.isEmpty():
                break
    return pairs.distinct(), texts


def dropped_lines(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(doc_id, t1, t2, dropped array<int>): line numbers, from 0, to drop from each row that has any."""
    lines = _lines(docs)
    distinct = _distinct_lines(lines, min_chars)
    pairs, texts = _candidates(distinct, lines)
    a = texts.toDF("a1", "a2", "a")
    b = texts.toDF("b1", "b2", "b")
    near = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).where(within_edits(F.col("a"), F.col("b"), 1))
    near = stored(near.select("a1", "a2", "b1", "b2"), "near-lines")
    first = distinct.select(*LINE, "first")
    placed = near.join(first.toDF("a1", "a2", "a_first"), ["a1", "a2"]).join(
        first.toDF("b1", "b2", "b_first"), ["b1", "b2"]
    )
    a_later = F.col("a_first") > F.col("b_first")
    late = placed.where("a_first <> b_first").select(
        F.when(a_later, F.col("a1")).otherwise(F.col("b1")).alias("h1"),
        F.when(a_later, F.col("a2")).otherwise(F.col("b2")).alias("h2"),
    )
    shadowed = late.distinct().withColumn("shadowed", F.lit(True))
    repeated = distinct.select(*LINE, "first", "n").join(shadowed, list(LINE), "left")
    repeated = repeated.where("n > 1 or shadowed").select(*LINE, "first", F.coalesce("shadowed", F.lit(False)).alias("shadowed"))
    at = lines.select(*ROW, "line_no", *LINE, _position().alias("position")).join(repeated, list(LINE))
    drop = at.where("shadowed or position <> first")
    return drop.groupBy(*ROW).agg(F.collect_set("line_no").alias("dropped"))


COUNTS = ("n_lines", "n_dropped")


def without_lines(docs: DataFrame, dropped: DataFrame, names: tuple[str, str] = COUNTS) -> DataFrame:
    """All columns of ``docs``, with the text of the lines that stay; adds two counts under ``names``.

    A column of one of these names is replaced.
    """
    docs = docs.drop(*names)
    side = dropped.toDF("_dropped_id", "_dropped_t1", "_dropped_t2", "_dropped")
    keyed = docs.select("*", F.col("text").cast("string").alias("_text")).select("*", *_hashes("_text", ("_t1", "_t2")))
    same_text = (F.col("_t1") == F.col("_dropped_t1")) & (F.col("_t2") == F.col("_dropped_t2"))
    joined = keyed.join(side, same_text & F.col("doc_id").cast("long").eqNullSafe(F.col("_dropped_id")), "left")
    joined = joined.withColumn("_lines", F.split(F.col("text").cast("string"), "\n"))
    n = F.coalesce(F.size("_lines"), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")
    return joined.select(
        *(c for c in docs.columns if c != "text"),
        F.when(F.col("_dropped").isNull() | F.col("text").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(n).alias(names[0]),
        F.when(F.col("text").isNull() | F.col("_dropped").isNull(), 0)
        .otherwise(F.size(F.array_intersect("_dropped", F.sequence(F.lit(0), F.size("_lines") - 1))))
        .alias(names[1]),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, names: tuple[str, str] = COUNTS) -> DataFrame:
    """``docs`` (doc_id, text, ...) without repeated and nearly repeated lines; adds counts of lines and dropped ones."""
    return without_lines(docs, dropped_lines(docs, min_chars), names)
