"""Phrases whose words belong together, mined by SON partitioning and counted exactly.

Documents are dealt to shards. A phrase of ``support`` occurrences in a language has,
in some shard, at least the shard's share of that number, so each shard is mined
completely at its proportionally lowered support: words and word pairs first, then
phrases of three and four words all of whose pairs are frequent in the shard. The
union of what the shards find holds every frequent phrase; all of it is then counted
in a second reading of the corpus, by the phrases' own text.

What a reading has to look for travels as bit filters of a fixed size. A filter only
says what cannot be frequent: a bit that is set by chance costs work, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import words
from eventlake.llm.store import stored

LONGEST = 4

BREAKS = words.separators(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
SEPARATORS = BREAKS | words.separators((0x20, 0x20), (0x09, 0x09))

# Phrases that a task gathers before it hands their counts on, and those it gathers with their text.
GATHERED, GATHERED_TEXTS = 1 << 20, 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Words and phrases of one slice of texts; hashes are made of the wanted numbers of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, orders: tuple[int, ...]):
        self.data = data
        hashes, bounds, self.starts, self.ends = words.word_hashes(data, offsets, SEPARATORS)
        self.row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(bounds))
        breaks = np.zeros(len(data) + 1, dtype=np.int32)
        np.cumsum(BREAKS[data], out=breaks[1:])
        # Breaks and rows both only rise, so equal sums are the same piece of the same row.
        piece = breaks[self.starts] + self.row
        seeds = seeds[self.row]
        rolling, self.hashes, self.inside = np.zeros(len(hashes), dtype=np.uint64), {}, {}
        for k in range(1, max(orders) + 1):
            rolling = rolling[: len(hashes) - k + 1] * _ODD + hashes[k - 1 :]
            if k in orders:
                self.hashes[k] = words.mix(rolling ^ seeds[: len(rolling)])
                self.inside[k] = piece[: len(rolling)] == piece[k - 1 :]

    def at(self, k: int) -> np.ndarray:
        """Where phrases of ``k`` words begin."""
        return np.flatnonzero(self.inside[k])


def _slices(batch: pa.RecordBatch, orders: tuple[int, ...]) -> Iterator[tuple[slice, Grams]]:
    seeds = batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64)
    for first, data, offsets in words.slices(batch.column("text")):
        rows = slice(first, first + len(offsets) - 1)
        yield rows, Grams(data, offsets, seeds[rows], orders)


# What shards a hash may be salted for: a shard and a number of words share eight bits.
MOST_SHARDS = 31

SALTS = words.mix(np.arange(1, MOST_SHARDS + 1, dtype=np.uint64) * _ODD)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places in a filter."""
    return (hashes & np.uint64((1 << bits) - 1)).astype(np.int64)


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (filter_[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _distinct(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key occurs once, and how often it occurs, or the sum of its ``n``."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if n is None:
        return order[first], np.diff(np.append(first, len(keys)))
    return order[first], np.add.reduceat(n[order], first, dtype=np.int64)


def _mine(orders: tuple[int, ...], pairs=None, bits: int = 0):
    """Counts of the phrases of a task's texts by shard and language; ``pairs`` is a filter of the pairs they may hold."""

    def run(batches):
        for batch in batches:
            shard = batch.column("shard").to_numpy(zero_copy_only=False)
            seed = batch.column("seed").to_numpy(zero_copy_only=False)
            held = {k: Held() for k in orders}
            for rows, grams in _slices(batch, orders if pairs is None else (2, *orders)):
                # A shard's phrases are told apart from those of others by a salt.
                salts = SALTS[shard[rows]][grams.row]
                near = None
                if pairs is not None:
                    salted = grams.hashes[2] ^ salts[: len(grams.hashes[2])]
                    near = _has(pairs.value, _places(salted, bits)) & grams.inside[2]
                for k in orders:
                    at = grams.at(k)
                    if near is not None:
                        for step in range(k - 1):
                            at = at[near[at + step]]
                    held[k].add(grams.hashes[k][at] ^ salts[at], grams.row[at] + np.int32(rows.start))
                    if held[k].is_full():
                        yield _counts(*held[k].take(), k, shard, seed)
            for k in orders:
                yield _counts(*held[k].take(), k, shard, seed)
            pa.default_memory_pool().release_unused()

    return run


class Held:
    """Phrases that a task has seen: salted hash, a row that has it, count."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        self.parts.append((hashes, rows, np.ones(len(hashes), dtype=np.int32)))
        self.size += len(hashes)

    def is_full(self) -> bool:
        """Whether much is held that does not repeat."""
        if self.size > GATHERED:
            self.parts = [self._merged()]
            self.size = len(self.parts[0][0])
        return self.size > GATHERED // 2

    def _merged(self):
        hashes, rows, n = (np.concatenate(c) for c in zip(*self.parts))
        self.parts = []
        at, n = _distinct(hashes, n)
        return hashes[at], rows[at], n

    def take(self):
        self.add(np.zeros(0, np.uint64), np.zeros(0, np.int32))
        merged, self.parts, self.size = self._merged(), [], 0
        return merged


def _counts(hashes, rows, n, k: int, shard: np.ndarray, seed: np.ndarray) -> pa.RecordBatch:
    kind = seed[rows] | (shard[rows].astype(np.int64) << 3) | k
    columns = [hashes.view(np.int64), kind, n.astype(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "kind", "n"])


def _count(candidates, bits: int):
    """Counts of candidate phrases with their text, as it stands in one place."""
    orders = tuple(range(1, LONGEST + 1))

    def gathered(parts, chunks, lang):
        hashes, rows, starts, ends = (np.concatenate(c) for c in zip(*parts))
        at, n = _distinct(hashes)
        starts, ends = starts[at], ends[at]
        limits = np.concatenate([[0], np.cumsum(ends - starts)])
        source = np.arange(limits[-1]) + np.repeat(starts - limits[:-1], ends - starts)
        text = np.concatenate(chunks)[source]
        phrases = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(text))
        yield pa.RecordBatch.from_arrays(
            [lang.take(pa.array(rows[at])), phrases.cast(pa.string()), pa.array(n)], names=["lang", "phrase", "n"]
        )

    def run(batches):
        for batch in batches:
            lang = batch.column("lang")
            parts, chunks, size, base = [], [], 0, 0
            for rows, grams in _slices(batch, orders):
                near = {k: _has(candidates.value, _places(grams.hashes[k], bits)) for k in orders}
                for k in orders:
                    at = np.flatnonzero(near[k] & grams.inside[k])
                    for step in range(k - 1):
                        at = at[near[2][at + step]]
                    spans = grams.starts[at] + base, grams.ends[at + k - 1] + base
                    parts.append((grams.hashes[k][at], grams.row[at] + np.int32(rows.start), *spans))
                    size += len(at)
                chunks.append(grams.data)
                base += len(grams.data)
                if size > GATHERED_TEXTS:
                    yield from gathered(parts, chunks, lang)
                    parts, chunks, size, base = [], [], 0, 0
            if size:
                yield from gathered(parts, chunks, lang)
            pa.default_memory_pool().release_unused()

    return run


def _filter(frequent: DataFrame, place, bits: int):
    """A broadcast filter of 2**bits bits with the places of these phrases set."""
    longs = frequent.select(place.alias("p")).groupBy(F.expr("p div 64").alias("at"))
    longs = longs.agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("v"))
    longs = longs.toArrow()
    out = np.zeros(1 << bits - 6, dtype=np.int64)
    out[longs["at"].to_numpy()] = longs["v"].to_numpy()
    return frequent.sparkSession.sparkContext.broadcast(out.view(np.uint8))


def phrase_counts(
    docs: DataFrame, support: int = 30, shards: int = 3, filter_bits: int = 27
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to 4 words with f >= ``support``, and (lang, n)
    of all words of the languages that have one.

    ``A-Z`` counts as ``a-z``; texts are cut at ``[.,;:!?\\x0A-\\x0D]``; words are runs
    of anything but space and tab; phrases stay within a piece. Null texts are empty, a
    null ``lang`` is ``und``. Equal rows count each. More than ``support`` shards would
    lower a shard's support to one occurrence.
    """
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"1 to {MOST_SHARDS} shards, not {shards}")
    lang = F.coalesce(F.col("lang"), F.lit("und"))
    seed = F.xxhash64("lang").bitwiseAND(-256)
    texts = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"), lang.alias("lang"), "text"
    ).withColumn("seed", seed)
    place = F.col("h").bitwiseAND((1 << filter_bits) - 1)

    def summed(orders, name, *filter_):
        # Language, shard and number of words are part of the hash; kind says them again.
        counts = texts.select("shard", "seed", "text").mapInArrow(_mine(orders, *filter_), "h long, kind long, n long")
        counts = stored(counts.groupBy("h").agg(F.sum("n").alias("n"), F.max("kind").alias("kind")), name)
        return counts.selectExpr(
            "h", "n", "kind & 7 as k", "cast((kind & 255) div 8 as int) as shard", "kind & -256 as seed"
        )

    short = summed((1, 2), "phrases-short")
    sizes = short.where("k = 1").groupBy("shard", "seed").agg(F.sum("n").alias("size"))
    sizes = stored(sizes, "phrases-sizes")
    totals = sizes.groupBy("seed").agg(F.sum("size").alias("n"))
    # The least count that is not below the shard's share of the support.
    least = sizes.join(totals, "seed").select(
        "shard", "seed", F.expr(f"({support} * size + n - 1) div n").alias("least")
    )

    def frequent(counts):
        return counts.join(least, ["shard", "seed"]).where("n >= least").select("k", "shard", "h")

    short = stored(frequent(short), "phrases-frequent")
    pairs = _filter(short.where("k = 2"), place, filter_bits)
    long = frequent(summed((3, 4), "phrases-long", pairs, filter_bits))
    salt = F.element_at(F.lit(SALTS.view(np.int64).tolist()), F.col("shard") + 1)
    union = short.unionByName(long).withColumn("h", F.col("h").bitwiseXOR(salt))
    candidates = _filter(union, place, filter_bits)
    counts = texts.select("lang", "seed", "text").mapInArrow(
        _count(candidates, filter_bits), "lang string, phrase string, n long"
    )
    # Signs between the words, and capitals, as they stood in the place that was kept.
    phrase = F.regexp_replace("phrase", "[\\x20\\x09]+", " ")
    phrase = F.translate(phrase, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = counts.groupBy("lang", phrase.alias("phrase")).agg(F.sum("n").alias("f")).where(F.col("f") >= support)
    counts = stored(counts, "phrase-counts")
    pairs.unpersist()
    candidates.unpersist()
    names = counts.select("lang").distinct().withColumn("seed", seed)
    return counts, names.join(totals, "seed").select("lang", "n")


def _parts(name: str, where: str):
    return F.expr(f"array_join({where}, ' ')").alias(name)


def collocations(
    docs: DataFrame, support: int = 30, top: int = 2000, shards: int = 3, filter_bits: int = 27
) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to 4 words by how firmly their words hold together.

    A phrase of ``a`` occurrences is cut after each of its words; a cut whose parts occur
    ``l`` and ``r`` times scores ``2000000 * a div (l + r)``, and the lowest cut counts,
    the first one among equals. A phrase goes when a longer one of at least 80 % of
    its occurrences holds it. Order: score, then a, both falling, then the phrase's
    bytes. Texts of null, and languages without frequent phrases, have no rows.

    Returns lang, rank, phrase, a, l, r, n, score.
    """
    counts, totals = phrase_counts(docs, support, shards, filter_bits)
    phrases = counts.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).where("size(w) > 1")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", _parts("left", "slice(w, 1, k)"), _parts("right", "slice(w, k + 1, size(w) - k)")
    )
    for side, count in (("left", "l"), ("right", "r")):
        known = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count))
        cuts = cuts.join(known, ["lang", side])
    score = F.expr("(2000000BD * cast(a as decimal(20))) div (cast(l as decimal(20)) + r)")
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.max("a").alias("a"))

    inner = F.expr(
        "flatten(transform(sequence(2, size(w) - 1),"
        " s -> transform(sequence(1, size(w) - s + 1), i -> array_join(slice(w, i, s), ' '))))"
    )
    held = phrases.where("size(w) > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = lowest.join(held, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 80 * a")
    ranked = left.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    rank = F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)")
    ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
