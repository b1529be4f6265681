"""Quality, language model and language ID: rules by brute force, accuracy on held-out rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import functions as F

from eventlake.llm import attention_lm, language_id, quality

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_gradients_of_the_link():
    rng = np.random.default_rng(0)
    line, grade, thresholds = rng.normal(size=20), rng.integers(0, 4, 20), np.array([-1.0, 0.2, 1.1])

    def likelihood(line, thresholds):
        bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
        return np.log(quality.sigmoid(line - bounds[grade]) - quality.sigmoid(line - bounds[grade + 1]))

    by_line, by_threshold = quality.link_gradient(line, grade, thresholds)
    e = 1e-6
    assert np.allclose(by_line, (likelihood(line + e, thresholds) - likelihood(line - e, thresholds)) / (2 * e), atol=1e-6)
    for k in range(3):
        step = np.eye(3)[k] * e
        assert np.allclose(
            by_threshold[:, k], (likelihood(line, thresholds + step) - likelihood(line, thresholds - step)) / (2 * e), atol=1e-6
        )


def rated(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.select("doc_id", quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))


def test_quality_orders_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, ratings = spark.read.parquet(f"{folder}/documents.parquet"), rated(spark, folder)
    held = F.col("doc_id") % 4 == 1
    weights, thresholds = quality.fit(docs, ratings.where(~held), grades=3)
    assert (np.diff(thresholds) > 0).all()
    scores = quality.score(docs, weights, thresholds).join(ratings.where(held), "doc_id").collect()
    by_grade = {g: np.mean([r.expected_grade for r in scores if r.grade == g]) for g in range(3)}
    assert by_grade[0] < by_grade[2] and by_grade[1] < by_grade[2]
    good = [r.tails[1] >= 0.5 for r in scores if r.grade == 2]
    poor = [r.tails[1] >= 0.5 for r in scores if r.grade == 1]
    toxic = [r.tails[1] >= 0.5 for r in scores if r.grade == 0]
    assert np.mean(good) > 0.95 and np.mean(poor) < 0.15 and np.mean(toxic) < 0.5


def test_quality_of_edges(spark, edge_docs, no_docs):
    ratings = spark.createDataFrame(
        [(1, 2), (1, 0), (5, 2), (None, 1), (7, None), (10, 1)], "doc_id long, grade int"
    )
    weights, thresholds = quality.fit(edge_docs, ratings, grades=3)
    rows = quality.score(edge_docs, weights, thresholds).collect()
    assert len(rows) == edge_docs.count()
    assert all(1 >= r.tails[0] >= r.tails[1] >= 0 for r in rows)
    assert quality.score(no_docs, weights, thresholds).count() == 0
    weights, _ = quality.fit(no_docs, ratings, grades=3)
    assert not weights.any()


# ------------------------------------------------------------ language ID


def longest_matches(text, sample):
    """Phrases of a lane by search in the sample."""
    at, count = 0, 0
    while at < len(text):
        length = 0
        while at + length < len(text) and text[at : at + length + 1] in sample:
            length += 1
        at += max(1, length)
        count += 1
    return count


def test_phrases_are_longest_matches():
    rng = np.random.default_rng(2)
    sample = rng.integers(1, 6, 300).astype(np.uint8)
    texts = [rng.integers(1, 7, n).astype(np.uint8) for n in (1, 30, 511, 512, 513, 1200)]
    parser = language_id.Parser.__new__(language_id.Parser)
    parser.walks = [language_id.walk_table(sample)]
    known = bytes(sample)
    expected = [
        sum(longest_matches(bytes(t[k : k + language_id.LANE]), known) for k in range(0, len(t), language_id.LANE))
        for t in texts
    ]
    assert parser.phrases(texts)[:, 0].tolist() == expected


def test_language_of_held_out_documents(documents):
    held = language_id.held_out(F.col("doc_id"), 4, 2)
    rows = language_id.identify(documents, language_id.learn(documents), keep=("doc_id", "lang")).where(held).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_edges(edge_docs, no_docs):
    samples = language_id.learn(edge_docs)
    rows = {r.doc_id: r for r in language_id.identify(edge_docs, samples).collect()}
    assert language_id.identify(edge_docs, samples).count() == edge_docs.count()
    assert {d for d, r in rows.items() if r.lang_pred == "und"} >= {2, 3, 4, 8}
    assert language_id.identify(no_docs, samples).count() == 0
    assert {r.lang_pred for r in language_id.identify(edge_docs, language_id.learn(no_docs)).collect()} == {"und"}


# ------------------------------------------------------------ language model


def test_gradients_of_the_model():
    rng = np.random.default_rng(0)
    w = attention_lm.start_weights(np.ones(attention_lm.CLASSES))
    inputs = rng.integers(0, attention_lm.INPUTS, (3, attention_lm.WINDOW)).astype(np.int32)
    targets = rng.integers(-1, attention_lm.CLASSES, (3, attention_lm.WINDOW)).astype(np.int32)
    found = attention_lm.gradients(w, inputs, targets)
    w = {name: x.astype(np.float64) for name, x in w.items()}

    def loss():
        h = attention_lm.attend(w, inputs)[0].reshape(-1, attention_lm.WIDTH)
        total, count = 0.0, 0
        for state, own in zip(h, targets.ravel()):
            if own >= 0:
                c = own // attention_lm.CLUSTER
                outer = state @ w["out"] + w["bias"]
                inner = state @ w["inner"][c] + w["inner_bias"][c]
                total += np.log(np.exp(outer).sum()) - outer[c]
                total += np.log(np.exp(inner).sum()) - inner[own % attention_lm.CLUSTER]
                count += 1
        return total / count

    for name in w:
        at = np.unravel_index(np.abs(found[name]).argmax(), found[name].shape)
        w[name][at] += 1e-4
        high = loss()
        w[name][at] -= 2e-4
        low = loss()
        w[name][at] += 1e-4
        assert math.isclose((high - low) / 2e-4, found[name][at], rel_tol=1e-2, abs_tol=1e-6)


def test_each_position_is_scored_once_and_shares_sum_to_one():
    lengths = np.arange(1, 200)
    text, first, begins = attention_lm.windows(lengths)
    seen = Counter()
    for t, f, b in zip(text, first, begins):
        for p in range(f + (0 if b else attention_lm.CONTEXT), min(f + attention_lm.WINDOW, lengths[t])):
            seen[t, p] += 1
    assert seen == Counter({(t, p): 1 for t, n in enumerate(lengths) for p in range(n)})


def test_states_for_scoring_are_those_of_training():
    rng = np.random.default_rng(4)
    w = attention_lm.start_weights(np.ones(attention_lm.CLASSES))
    w = {name: x * 3 for name, x in w.items()}
    inputs = rng.integers(0, attention_lm.INPUTS, (5, attention_lm.WINDOW))
    expected = attention_lm.attend(w, inputs)[0]
    assert np.allclose(attention_lm.states(attention_lm.projected(w), inputs), expected, atol=1e-4)


def test_shares_of_what_may_follow_sum_to_one():
    counts = np.zeros(5000)
    counts[:40] = 7
    vocabulary = attention_lm.Vocabulary(counts, 3)
    w = attention_lm.start_weights(vocabulary.class_counts)
    state = attention_lm.attend(w, np.full((1, attention_lm.WINDOW), attention_lm.INPUTS - 1, np.int32))[0][0, 0]
    outer = attention_lm._softmax(state @ w["out"] + w["bias"])
    inner = np.stack([attention_lm._softmax(state @ w["inner"][c] + w["inner_bias"][c]) for c in range(attention_lm.CLUSTERS)])
    classes = (outer[:, None] * inner).ravel()
    other = vocabulary.classes == attention_lm.CLASSES - 2
    ids = classes[vocabulary.classes] * np.where(other, np.exp(vocabulary.within), 1)
    assert math.isclose(ids.sum() + classes[-1], 1, rel_tol=1e-4)
    empty = attention_lm.log_probabilities(w, vocabulary, [np.zeros(0, np.int64)])[0]
    assert math.isclose(empty, math.log10(classes[-1]), rel_tol=1e-4)


def base_scores(rows):
    """{row: (tokens, known, base score)} and the number of training tokens."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for _, t in rows]
    learned = [d is None or zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows]
    counts = Counter(w for ws, own in zip(split, learned) if own for w in ws)
    total = sum(counts.values())
    scale = total + len(counts) + 1
    out = [
        (d, not own, len(ws), sum(counts[w] > 0 for w in ws), total, round(sum(math.log10((counts[w] + 1) / scale) for w in ws), 6))
        for (d, _), ws, own in zip(rows, split, learned)
    ]
    return sorted(out, key=str)


def scored(docs):
    found = attention_lm.score(docs, PATH, 50_257).collect()
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    return sorted(((*r[:5], round(r.base_score, 6)) for r in map(tuple_of, found)), key=str), found


def tuple_of(r):
    class Row(tuple):
        base_score = r.base_score

    return Row((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens))


def test_scores_of_the_table(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    found, raw = scored(documents)
    assert found == base_scores(rows)
    assert len({r.doc_id for r in raw if r.held_out}) > 5


def test_rare_words_are_joined(documents, monkeypatch):
    monkeypatch.setattr(attention_lm, "FREQUENT_WORDS", 20)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert scored(documents)[0] == base_scores(rows)


def test_scores_of_edges(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert scored(edge_docs)[0] == base_scores(rows)
    assert attention_lm.score(no_docs, PATH, 50_257).count() == 0


def test_features_do_not_depend_on_the_batch():
    texts = ["one two three", "", None, "ONE two", "x " * 100]
    alone = [next(iter(quality.features(pa.array([t]))))[1].tolist() for t in texts]
    assert [at.tolist() for _, at, _ in quality.features(pa.array(texts))] == alone


def test_all_windows_of_a_text_are_learned_from(monkeypatch):
    monkeypatch.setattr(attention_lm, "MIXED", 300)
    monkeypatch.setattr(attention_lm, "BATCH", 64)
    vocabulary = attention_lm.Vocabulary(np.arange(5000, 0, -1.0), 3)
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 4000, n).astype("<u2") for n in (0, 5, 31, 32, 700, 20_000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in part], pa.binary())], ["ids"]) for part in (texts[:3], texts[3:])]
    found = list(attention_lm._mixed(vocabulary, 0, iter(batches)))
    assert all(len(x) == 64 for x, _ in found[:-1])
    learned = Counter(c for _, y in found for c in y.ravel().tolist() if c >= 0)
    assert learned == Counter(c for t in texts for c in [*vocabulary.classes[t].tolist(), attention_lm.CLASSES - 1])
    assert sum(len(x) for x, _ in found) == len(attention_lm.windows(np.array([len(t) + 1 for t in texts]))[0])


def test_weights_are_averaged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "FAN", 2)
    w = {"a": np.zeros(2, np.float32)}
    rows = [(s, s + 1, bytearray(np.array([s, 1], "<f4").tobytes())) for s in range(9)]
    found = attention_lm.averaged(w, spark.createDataFrame(rows, attention_lm.FITTED), 9)["a"]
    assert np.allclose(found, [sum(s * (s + 1) for s in range(9)) / 45, 1])
    assert attention_lm.averaged(w, spark.createDataFrame([], attention_lm.FITTED), 9) is w
