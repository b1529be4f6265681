"""Private spans: base kinds against plain patterns, EM against its definition, added spans on planted ones."""

import hashlib
import random
import re
from math import isclose

import pytest

from eventlake.llm import private_spans as ps
from eventlake.llm import queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def counts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    spans = [
        (m.start(), order, m.end(), kind)
        for order, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if counts(kind, m.group())
    ]
    return sorted(spans)


def row(text):
    spans = base(text)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
    return (*(sum(k == kind for *_, k in spans) for kind in PLAIN), hashlib.sha256(joined.encode()).hexdigest())


COLUMNS = "n_email n_ip n_card n_phone base_sha256".split()


def check(docs, found):
    expected = sorted(((r["doc_id"] is None, r["doc_id"], *row(r["text"])) for r in docs.collect()), key=str)
    rows = found.collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows), key=str) == expected
    for r in rows:  # base spans are among all spans
        kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
        assert [kinds.count(k) for k in PLAIN] == [r[f"n_{k}"] for k in PLAIN]
        assert sum(k not in PLAIN for k in kinds) == r["n_added"]
    return rows


def test_query_has_the_base_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = check(docs, queries.queries()["op12_private_spans"](spark, sf_dir))
    assert sum(r["n_email"] for r in rows)


def test_edges(spark, edge_docs, no_docs):
    check(edge_docs, ps.scan(edge_docs))
    assert ps.scan(no_docs).count() == 0


def test_odd_texts_match_as_the_plain_patterns_do(spark):
    draw = random.Random(5)
    pieces = ["a", "b.c", "@", ".", "-", "1", "22", "255", "256", " ", "+", "(", ")", "_", "%", "é", "😀", "x@y.z", "4111 1111 1111 1111"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 60))) for _ in range(1500)]
    texts += ["1.2.3.4.5.6.7.8", "a@b.c.d_x@e.f", "0000000000000001.2.3.0255", "+1 (2) 3-4.5 678 9-", "a@b.c@d.e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs, ps.scan(docs))


def test_many_matches_and_long_runs(spark):
    """Running sums over several chunks; runs that plain patterns would try from each sign."""
    many = " ".join(f"u{i}@mail.org 10.0.{i % 300}.{i % 256}" for i in range(700))
    docs = spark.createDataFrame(
        [(1, many), (2, "a" * 300_000), (3, "1" * 100_000), (4, "1 " * 50_000), (5, "Aa" * 100_000), (6, "x@" + "a." * 50_000)],
        "doc_id long, text string",
    )
    rows = {r["doc_id"]: r for r in ps.scan(docs).collect()}
    for key in (1, 4):
        text = next(r["text"] for r in docs.collect() if r["doc_id"] == key)
        assert tuple(rows[key][c] for c in COLUMNS) == row(text)
    assert rows[6]["n_email"] == 1


def test_em_recovers_reliabilities():
    """Votes drawn from known reliabilities; the estimate is near them and posteriors follow Bayes."""
    draw = random.Random(1)
    truth = ({1: 0.8, 0: 0.15, -1: 0.05}, {1: 0.05, 0: 0.25, -1: 0.7})
    patterns = {}
    for _ in range(20_000):
        side = truth[0] if draw.random() < 0.4 else truth[1]
        votes = tuple(draw.choices((1, 0, -1), [side[1], side[0], side[-1]])[0] for _ in ps.LABELERS)
        patterns[votes] = patterns.get(votes, 0) + 1
    prior, tables, posterior = ps.reliabilities(patterns)
    assert abs(prior - 0.4) < 0.02
    for table in tables:
        for found, known in zip(table, truth):
            assert all(abs(found[v] - known[v]) < 0.03 for v in known)
    votes = next(iter(patterns))
    yes, no = 0.4, 0.6
    for v in votes:
        yes, no = yes * truth[0][v], no * truth[1][v]
    assert abs(posterior[votes] - yes / (yes + no)) < 0.05


def test_classifier_is_the_minimum_of_its_loss():
    rows = [(("a", "x"), 50.0, 40.0), (("a", "y"), 30.0, 3.0), (("b", "x"), 20.0, 11.0)]
    weights = ps.classifier(rows, rounds=3000)
    from math import exp

    for name in weights:
        slope = -weights[name]
        for names, n, yes in rows:
            if name in names:
                slope += yes - n / (1 + exp(-sum(weights[x] for x in names)))
        assert isclose(slope, 0, abs_tol=1e-6)


@pytest.fixture(scope="module")
def planted(spark):
    draw = random.Random(9)
    rows = []
    for i in range(400):
        words = [draw.choice(["some", "plain", "words", "of", "text", "here"]) for _ in range(30)]
        key = "%040x" % draw.getrandbits(160)
        if i % 4 == 0:
            words[10] = f'token = "{key}"'
        if i % 4 == 1:
            words[10] = "contact: Maria Keller,"
        if i % 4 == 2:
            words[10] = f"ssn: {draw.randrange(100, 999)}-{draw.randrange(10, 99)}-{draw.randrange(1000, 9999)};"
        if i % 40 == 3:
            words[10] = "version 2021-10-12 General License 12345678"
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_planted_spans_are_found_and_plain_texts_left_alone(planted):
    kinds = {0: "secret", 1: "name", 2: "number"}
    for r in ps.scan(planted).where("n_card = 0 and n_phone = 0").collect():  # hex digits may hold a card
        found = [s.split(":")[0] for s in r["spans"].split(",") if s]
        assert found == ([kinds[r["doc_id"] % 4]] if r["doc_id"] % 4 in kinds else []), r
