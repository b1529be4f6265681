"""Words and word shingles of whole Arrow batches as 64-bit hashes, by numpy.

A word is a run of bytes other than space and ``\\x09-\\x0D``; ``A-Z`` counts as
``a-z``. All functions work on UTF-8 bytes, so text is never decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from eventlake.llm.worker import SHARED, kept

# Bytes that are hashed at once, at some 60 bytes of arrays each; a longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of which bytes separate words."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


WHITE_SPACE = separators((0x20, 0x20), (0x09, 0x0D))


def _letters(fold: bool) -> np.ndarray:
    """One 64-bit value per byte; with ``fold`` upper and lower case share theirs."""
    table = mix((np.arange(1, 257, dtype=np.uint64)) * _ODD)
    if fold:
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    return table


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What hashing needs for every slice: powers, and letters with and without case."""
    return *_powers(SLICE_BYTES), _letters(False), _letters(True)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.ones(n, dtype=np.uint64)
        done = 1
        while done < n:
            step = min(done, n - done)
            powers[done : done + step] = powers[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        out.append(powers)
    return out[0], out[1]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text column: first row, its bytes, offsets of its rows.

    Null texts are empty.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = max(last, first + 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE_SPACE):
    """(starts, ends, number of words before each row and in total)."""
    size = len(data)
    inside = np.zeros(size + 1, dtype=bool)
    np.logical_not(separator[data], out=inside[:size])
    begins = inside[:size].copy()
    begins[1:] &= ~inside[: size - 1] if size else inside[:0]
    edges = offsets[1:-1]
    edges = edges[edges < size]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    closes = inside[:size] & ~inside[1:]
    before = edges[edges > 0] - 1
    closes[before] = inside[before]
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hashes of byte spans; ``fold`` makes upper and lower case alike."""
    size = len(data)
    length = max(SLICE_BYTES, 1 << int(size).bit_length())
    up, down, *letters = kept(SHARED, _tables)
    if length > SLICE_BYTES:  # tables for one very long text are not kept
        up, down = _powers(length)
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(letters[fold][data] * up[:size], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE_SPACE):
    """(hashes of all words, number of words before each row and in total, starts, ends)."""
    starts, ends, bounds = word_spans(data, offsets, separator)
    return span_hashes(data, starts, ends), bounds, starts, ends


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of each row, and their bounds per row.

    A row of fewer words has its whole sequence as its one n-gram; a row without
    words has none.
    """
    counts = np.diff(bounds)
    full = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    factor = 1
    for k in range(width):
        factor = factor * _BASE & _MASK
        full += hashes[k : k + len(full)] * np.uint64(factor)
    full = mix(full)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(out_bounds[-1], dtype=np.uint64)
    rows = np.repeat(np.arange(len(counts)), sizes)
    source = bounds[:-1][rows] + np.arange(len(out)) - out_bounds[:-1][rows]
    long_enough = (counts >= width)[rows]
    out[long_enough] = full[source[long_enough]]
    for row in np.flatnonzero((counts > 0) & (counts < width)):
        value = 0
        for h in hashes[bounds[row] : bounds[row + 1]]:
            value = (value * 31 + int(h)) * _BASE & _MASK
        out[out_bounds[row]] = mix(np.array([value ^ 0x5555], dtype=np.uint64))[0]
    return out, out_bounds


def shingle_rows(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes in text order) of every row."""
    for first, data, offsets in slices(texts):
        hashes, bounds, _, _ = word_hashes(data, offsets)
        grams, limits = shingle_hashes(hashes, bounds, width)
        for row in range(len(offsets) - 1):
            yield first + row, grams[limits[row] : limits[row + 1]]
