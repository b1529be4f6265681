"""Document fingerprints by consistent weighted sampling.

A document is a set of weighted terms: its words, and its word pairs, weighted by
how often they occur. For each of ``SAMPLES`` hash functions a term k of weight
w draws r, c from Gamma(2, 1) and b from [0, 1) by its hash, and has

    t = floor(ln w / r + b),  ln y = r (t - b),  ln a = ln c - ln y - r

The term with the least a and its t are the sample. Two documents have the same
sample with a probability that equals the generalised Jaccard similarity of their
weights, sum of minima over sum of maxima. A fingerprint is 16 bits of each
sample, in hexadecimal; ``likeness`` is the share of equal samples.

Nulls: a null text is empty. Texts without words have one term, the text itself.
Equal texts have equal fingerprints. The next document is the one that follows in
ascending ``doc_id``, rows of one id in the order of their text, null ids first;
the last is followed by the first. A single document follows itself. Rows are
kept one for one. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import words
from eventlake.llm.worker import kept

SAMPLES = 64
# Terms that are sampled at once; their arrays stay in a core's cache.
SLICE_TERMS = 1 << 9
# Terms of the bags that are sampled together, and of the table of their draws.
GROUP_TERMS = 1 << 15
TABLE_TERMS = 1 << 14
# UTF-8 bytes of text per range of document ids, about.
RANGE_BYTES = 16 << 20

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


# ------------------------------------------------------------ sampling


def _gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at 65,536 even steps, by bisection of 1 - (1 + x) exp(-x)."""
    wanted = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(1 << 16), np.full(1 << 16, 64.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < wanted
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return ((low + high) / 2).astype(np.float32)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = _gamma_table()
    seeds = words.mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return r, np.log(r), seeds


def draws(terms: np.ndarray, log_weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln a of each term and hash function, and 16 bits of (term, t)."""
    r_table, log_c_table, seeds = kept("gamma", _tables)
    bits = terms[:, None] ^ seeds[None, :]
    bits *= np.uint64(0xD6E8FEB86659FD93)
    bits ^= bits >> np.uint64(32)
    bits *= np.uint64(0x9FB21C651E98DF25)
    parts = bits.view(np.uint16).reshape(*bits.shape, 4)
    r, log_c = r_table.take(parts[..., 3]), log_c_table.take(parts[..., 2])
    b = parts[..., 1] * np.float32(1 / (1 << 16))
    if not log_weights.any():  # then t is 0
        b *= r
        b += log_c
        b -= r
        return b, parts[..., 0]
    t = np.floor(log_weights[:, None].astype(np.float32) / r + b)
    codes = parts[..., 0] ^ (t.astype(np.int32) * 0x9E37).astype(np.uint16)
    return log_c - r * (t - b) - r, codes


def samples(bags: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The samples of each bag of weighted terms.

    A term draws once per weight that it has among the bags; a bag then looks its terms up.
    """
    bounds = np.concatenate([[0], np.cumsum([len(terms) for terms, _ in bags])])
    terms, weights = (np.concatenate(x) for x in zip(*bags))
    keys = terms + words.mix(weights.astype(np.uint64) - np.uint64(1))
    _, at, place = np.unique(keys, return_index=True, return_inverse=True)
    # Terms of weight one need no logarithm; keep them together.
    order = np.argsort(weights[at] > 1, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    place, terms, weights = rank[place], terms[at][order], weights[at][order]
    ones, logs = int(np.searchsorted(weights > 1, True)), np.log(weights)
    best = np.full((len(bags), SAMPLES), np.inf, dtype=np.float32)
    code = np.zeros((len(bags), SAMPLES), dtype=np.uint16)
    column = np.arange(SAMPLES)
    for low in range(0, len(terms), TABLE_TERMS):
        high = min(low + TABLE_TERMS, len(terms))
        cut = min(max(ones, low), high)
        scores = np.empty((high - low, SAMPLES), dtype=np.float32)
        codes = np.empty((high - low, SAMPLES), dtype=np.uint16)
        edges = [*range(low, cut, SLICE_TERMS), *range(cut, high, SLICE_TERMS), high]
        for first, last in zip(edges, edges[1:]):
            scores[first - low : last - low], codes[first - low : last - low] = draws(terms[first:last], logs[first:last])
        for bag in range(len(bags)):
            own = place[bounds[bag] : bounds[bag + 1]]
            if len(terms) > TABLE_TERMS:
                own = own[(own >= low) & (own < high)] - low
            if not len(own):
                continue
            drawn = scores.take(own, axis=0)
            least = drawn.argmin(axis=0)
            found = drawn[least, column]
            better = found < best[bag]
            best[bag][better] = found[better]
            code[bag][better] = codes[own[least], column][better]
    return list(code)


def signature(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The samples of a document's weighted terms."""
    return samples([(terms, weights)])[0]


def _bags(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Weighted terms of each text."""
    for _, data, offsets in words.slices(pa.array(texts, pa.large_string())):
        hashes, bounds, _, _ = words.word_hashes(data, offsets)
        for row in range(len(offsets) - 1):
            own = hashes[bounds[row] : bounds[row + 1]]
            if not len(own):
                term = xxhash.xxh3_64_intdigest(data[offsets[row] : offsets[row + 1]].tobytes())
                own = np.array([term], dtype=np.uint64)
            pairs = words.mix(own[:-1] * np.uint64(0xD6E8FEB86659FD93) + own[1:])
            yield np.unique(np.concatenate([own, pairs]), return_counts=True)


def signatures(texts: list[str]) -> list[np.ndarray]:
    """The fingerprint of each text, as numbers. Neighbours that share terms share draws."""
    out, group, size = [], [], 0
    for bag in _bags(texts):
        if group and size + len(bag[0]) > GROUP_TERMS:
            out += samples(group)
            group, size = [], 0
        group.append(bag)
        size += len(bag[0])
    return out + samples(group) if group else out


def as_text(code: np.ndarray) -> str:
    return code.astype(">u2").tobytes().hex()


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


# ------------------------------------------------------------ documents and their followers


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first characters of another."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SCHEMA``; each row's follower is the next row of its range, guests last."""
    held = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))
        rows = [held] if held else []
        rows += zip(*columns)
        held = rows[-1]
        yield from _pairs(rows)


def _pairs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the last, and but guests, in pieces of bounded size."""
    first = 0
    while first < len(rows) - 1:
        last, size = first, 0
        while last < len(rows) - 1 and (last == first or size < words.SLICE_BYTES):
            size += len(rows[last][3] or "")
            last += 1
        texts = [r[3] or "" for r in rows[first : last + 1]]
        changed = [edited(x, y) for x, y in zip(texts, texts[1:])]
        codes = signatures([x for pair in zip(texts, changed) for x in pair] + texts[-1:])
        found, after = codes[::2], codes[1::2]
        out = []
        for at, (span, guest, doc_id, _) in enumerate(rows[first:last]):
            if guest or rows[first + at + 1][0] != span:
                continue
            out.append(
                (
                    doc_id,
                    len(texts[at]),
                    hashlib.sha256(changed[at].encode()).hexdigest(),
                    as_text(found[at]),
                    as_text(after[at]),
                    likeness(found[at], after[at]),
                    likeness(found[at], found[at + 1]),
                )
            )
        if out:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])
        first = last


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows of ``SCHEMA`` per row of ``docs`` (doc_id, text).

    Documents are dealt into ranges of ids. The first document of a range, and of
    the table, is also a guest at the end of the range before; so each text is
    shuffled once, and the few first ones twice.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    ranges = max(1, (size or 0) // RANGE_BYTES)
    shares = [x / ranges for x in range(1, ranges)]
    cuts = sorted(set(rows.agg(F.percentile_approx("key", shares, 10 * ranges)).first()[0])) if shares and count else []
    at = F.lit(0)
    if cuts:
        bounds = F.array(*(F.lit(c) for c in cuts)) if len(cuts) < 1000 else None
        at = _range_of(F.col("key"), cuts) if bounds is None else F.size(F.filter(bounds, lambda c: c <= F.col("key")))
    rows = rows.withColumn("range", at)
    firsts = {r["range"]: r["key"] for r in rows.groupBy("range").agg(F.min("key").alias("key")).collect()}
    order = sorted(firsts)
    guests = [(firsts[b], a) for a, b in zip(order, order[1:])] + [(firsts[order[0]], order[-1])] if order else []
    guest_of = docs.sparkSession.createDataFrame(guests, "key long, host int").groupBy("key").agg(
        F.collect_list("host").alias("hosts")
    )
    # One row per range.
    rows = rows.join(F.broadcast(guest_of), "key", "left")
    visits = F.transform(F.coalesce("hosts", F.array().cast("array<int>")), lambda h: F.struct(h.alias("range"), F.lit(True).alias("guest")))
    own = F.array(F.struct(F.col("range").cast("int").alias("range"), F.lit(False).alias("guest")))
    rows = rows.select("doc_id", "text", "key", F.explode(F.concat(own, visits)).alias("place"))
    rows = rows.select("place.range", "place.guest", "doc_id", "key", "text")
    rows = rows.repartition(ranges, "range").sortWithinPartitions("range", "guest", "key", "text")
    return rows.drop("key").mapInArrow(_fingerprints, SCHEMA)


def _range_of(key, cuts: list[int]):
    """The number of cuts at or below a key, for many cuts: a search by UDF on ids alone."""

    @F.pandas_udf("int")
    def search(keys):
        return keys.map(lambda k: bisect_right(cuts, k))

    return search(key)
