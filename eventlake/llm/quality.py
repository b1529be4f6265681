"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered classes 0, 1, ... One weight vector w over hashed text
features x is shared by all of them, and ordered thresholds t cut its line:

    P(grade >= k) = sigmoid(w x - t_k)

The expected grade is the sum of these tail probabilities, and the tail
probability of the wanted grade decides about selection.

Features of a text are its distinct hashed words and word stems and the ranges
that its shape falls in (capitals, marks, digits, word length, repetition). Fitting takes a
bounded sample, ``max_rows`` rated documents by the smallest hashes, in
up to ``SHARDS`` shards. In each round every shard runs Adagrad on its rows from the
common weights and the results are averaged.

Nulls: ratings with a null are left out; of several ratings of a document the
lowest grade counts. A null text is empty and is scored by its shape. A null
``doc_id`` is scored like others. Without rated documents of two grades the
weights are zero and every score is that of the thresholds' start. Rows are kept
one for one. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm import words
from eventlake.llm.store import stored

# Hashed features, and those of a text's shape in front of them.
FEATURES = 1 << 17
SHAPES, RANGES = 6, 16
# Words are runs of letters and digits; a stem is the first bytes of a word.
BETWEEN = words.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
STEM_BYTES = 4
# A word counts for the less, the more of them a text has.
WORD_POWER, SHAPE_VALUE = 0.5, 0.25
# Most shards, and rows that a shard should have at least.
SHARDS, SHARD_ROWS = 8, 1024
BATCH_ROWS = 32
# Rows of a shard that a feature must have to be learned.
LEAST_ROWS = 3


# ------------------------------------------------------------ features


def _shape(data: np.ndarray, grams: int, distinct: int, count: int) -> list[int]:
    """Feature numbers of a text's shape, one per property."""
    size = max(1, len(data))
    capitals = ((data >= 65) & (data <= 90)).sum() / size
    digits = ((data >= 48) & (data <= 57)).sum() / size
    marks = ((data >= 33) & (data <= 47) | (data >= 58) & (data <= 64) | (data >= 91) & (data <= 96) | (data >= 123) & (data <= 126)).sum() / size
    repeated = 1 - distinct / grams if grams else 0.0
    values = [
        np.sqrt(capitals) * RANGES,
        np.sqrt(digits) * RANGES,
        np.sqrt(marks) * RANGES,
        len(data) / max(1, count) / 2,
        repeated * RANGES,
        np.log2(count + 1),
    ]
    return [at * RANGES + min(RANGES - 1, int(v)) for at, v in enumerate(values)]


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, feature numbers, values) of each text."""
    for first, data, offsets in words.slices(texts):
        hashes, bounds, starts, ends = words.word_hashes(data, offsets, BETWEEN)
        stems = words.span_hashes(data, starts, np.minimum(ends, starts + STEM_BYTES)) ^ np.uint64(1 << 63)
        grams, limits = words.shingle_hashes(hashes, bounds, 3)
        for row in range(len(offsets) - 1):
            span = slice(bounds[row], bounds[row + 1])
            own = np.unique(np.concatenate([hashes[span], stems[span]]) % np.uint64(FEATURES - SHAPES * RANGES))
            pieces = grams[limits[row] : limits[row + 1]]
            distinct = len(np.unique(pieces))
            shape = _shape(data[offsets[row] : offsets[row + 1]], len(pieces), distinct, bounds[row + 1] - bounds[row])
            at = np.concatenate([np.array(shape), own.astype(np.int64) + SHAPES * RANGES])
            values = np.full(len(at), (1 + len(own)) ** -WORD_POWER, dtype=np.float32)
            values[:SHAPES] = SHAPE_VALUE
            yield first + row, at.astype(np.int32), values


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, values = [], []
        for _, x, v in features(batch.column("text")):
            at.append(x)
            values.append(v)
        columns = [batch.column("grade"), batch.column("h")]
        columns += [pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, ["grade", "h", "at", "values"])


# ------------------------------------------------------------ the model


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def link_gradient(line: np.ndarray, grade: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the mean-free log likelihood: for each row's line, and rows x thresholds."""
    bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
    low, high = bounds[grade], bounds[grade + 1]
    above, beyond = sigmoid(line - low), sigmoid(line - high)
    chance = np.maximum(above - beyond, 1e-9)
    by_line = 1 - above - beyond
    by_threshold = np.zeros((len(line), len(thresholds) + 2))
    rows = np.arange(len(line))
    by_threshold[rows, grade] = -above * (1 - above) / chance
    by_threshold[rows, grade + 1] += beyond * (1 - beyond) / chance
    return by_line, by_threshold[:, 1:-1]


def ordered(thresholds: np.ndarray) -> np.ndarray:
    """Thresholds in ascending order with a least distance."""
    out = np.sort(thresholds)
    for at in range(1, len(out)):
        out[at] = max(out[at], out[at - 1] + 1e-3)
    return out


def _fit_shard(weights: np.ndarray, thresholds: np.ndarray, balance: np.ndarray, passes: int, rate: float, batches):
    """One shard's rounds of Adagrad, from the common weights."""
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("h", "grade", "at", "values")))
    if not rows:
        return
    rows.sort(key=lambda r: r[0])
    grades = np.array([r[1] for r in rows])
    at = [np.array(r[2], dtype=np.int64) for r in rows]
    values = [np.array(r[3], dtype=np.float64) for r in rows]
    # Only features of several rows move; the others would learn rows by heart.
    counts = np.bincount(np.concatenate(at), minlength=len(weights))
    active = np.flatnonzero(counts >= LEAST_ROWS)
    place_of = np.full(len(weights), -1)
    place_of[active] = np.arange(len(active))
    known = [place_of[x] >= 0 for x in at]
    values = [v[k] for v, k in zip(values, known)]
    at = [place_of[x[k]] for x, k in zip(at, known)]
    moved, thresholds = weights[active].astype(np.float64), thresholds.astype(np.float64)
    seen, seen_t = np.full(len(active), 1e-2), np.full(len(thresholds), 1.0)
    for number in range(passes):
        order = np.random.default_rng(number).permutation(len(rows))
        for first in range(0, len(order), BATCH_ROWS):
            chosen = order[first : first + BATCH_ROWS]
            sizes = np.array([len(at[r]) for r in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            places = np.concatenate([at[r] for r in chosen])
            amounts = np.concatenate([values[r] for r in chosen])
            line = np.bincount(owner, moved[places] * amounts, len(chosen))
            by_line, by_threshold = link_gradient(line, grades[chosen], thresholds)
            share = balance[grades[chosen]]
            step = np.bincount(places, (by_line * share)[owner] * amounts, len(active))
            seen += step * step
            moved += rate * step / np.sqrt(seen) - 1e-5 * moved
            step = (by_threshold * share[:, None]).sum(axis=0)
            seen_t += step * step
            thresholds = ordered(thresholds + rate * step / np.sqrt(seen_t))
    # What moved, and how far: the driver gets little from shards of few rows.
    change = (moved - weights[active]).astype("<f4")
    columns = [pa.array([len(rows)]), pa.array([active.astype("<i4").tobytes()], pa.binary())]
    columns += [pa.array([change.tobytes()], pa.binary()), pa.array([thresholds.tolist()])]
    yield pa.RecordBatch.from_arrays(columns, ["n", "at", "change", "thresholds"])


def fit(
    docs: DataFrame, ratings: DataFrame, grades: int, max_rows: int = 16_384, rounds: int = 4, passes: int = 20, rate: float = 0.5
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) from ``ratings`` (doc_id, grade) of ``docs`` (doc_id, text)."""
    weights, thresholds = np.zeros(FEATURES, np.float32), np.arange(grades - 1) - (grades - 2) / 2
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    h = F.xxhash64("doc_id")
    sample = rated.select(F.col("doc_id").alias("rated_id"), F.col("grade").cast("int").alias("grade"), h.alias("h"))
    sample = sample.orderBy("h", "rated_id").limit(max_rows)
    # At most max_rows rows of three numbers.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("rated_id"))
    texts = texts.select("text", "grade", "h")
    rows = texts.mapInArrow(_training_rows, "grade int, h long, at array<int>, values array<float>")
    rows = stored(rows, "rated-features")
    counts = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    if len(counts) < 2:
        return weights, thresholds
    balance = np.array([sum(counts.values()) / (len(counts) * counts[g]) if g in counts else 0.0 for g in range(grades)])
    shards = max(1, min(SHARDS, sum(counts.values()) // SHARD_ROWS))
    sharded = rows.repartition(shards, "h")
    for _ in range(rounds):
        step = partial(_fit_shard, weights, thresholds, np.sqrt(balance), passes, rate)
        # One row per shard, of FEATURES numbers at most.
        found = sharded.mapInArrow(step, "n long, at binary, change binary, thresholds array<double>").collect()
        total = sum(r["n"] for r in found)
        moved = weights.astype(np.float64)
        for r in found:
            moved[np.frombuffer(r["at"], "<i4")] += np.frombuffer(r["change"], "<f4") * (r["n"] / total)
        weights = moved.astype(np.float32)
        thresholds = ordered(sum(np.array(r["thresholds"]) * (r["n"] / total) for r in found))
    return weights, thresholds


def _scores(weights: np.ndarray, thresholds: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        line = np.zeros(batch.num_rows)
        for row, at, values in features(batch.column("text")):
            line[row] = weights[at] @ values
        tails = sigmoid(line[:, None] - thresholds[None, :])
        columns = [batch.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails.tolist(), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", "tails"])


def score(docs: DataFrame, weights: np.ndarray, thresholds: np.ndarray) -> DataFrame:
    """(doc_id, expected_grade, tails): tails[k - 1] is the probability of grade k or better."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        partial(_scores, weights, thresholds), "doc_id long, expected_grade double, tails array<double>"
    )


def grade_of(quality: Column, toxic: Column) -> Column:
    """Ratings as a grade: 0 toxic, 1 poor, 2 good."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic > 0, 0).otherwise(F.least(quality, F.lit(1)) + 1)
