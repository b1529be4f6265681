"""Notices that are wrapped over lines."""

import random
import textwrap

import pytest

from eventlake.llm import license_scan


def window_labels(text):
    """Labels of all templates that consecutive words of a text contain well enough."""
    marks = str.maketrans({c: " " for c in license_scan.string.punctuation})
    have, out = text.lower().translate(marks).split(), set()
    for label, template in license_scan.TEMPLATES:
        need, span = set(license_scan._template_words(template)), license_scan._window(template)
        for at in range(len(have)):
            if len(need & set(have[at : at + span])) >= license_scan.THRESHOLD * len(need):
                out.add(label)
    return out


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    return [rows[at] for at in range(len(texts))]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices_are_found(spark, mark):
    body = "some words before it that say nothing of the kind\n"
    texts = [
        body + "\n".join(mark + x for x in textwrap.wrap(template, max(18, len(template) // 3))) + "\n" + body
        for _, template in license_scan.TEMPLATES
    ]
    for (label, _), row in zip(license_scan.TEMPLATES, labels(spark, texts)):
        assert label in row.labels.split(",") and row.score == 1.0


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        _, template = rng.choice(license_scan.TEMPLATES)
        parts = template.split()
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(parts))
            parts[at : at + rng.randrange(2)] = rng.choice([[], ["other"], ["rem", "rem"]])
        filler = [rng.choice(["the", "license", "rights", "all", "work", "fish"]) for _ in range(40)]
        # A word a line: no line holds a template.
        texts.append("\n".join(filler[:20] + " ".join(parts).split() + filler[20:]))
    found = labels(spark, texts)
    base = [set(filter(None, r.base_labels.split(","))) for r in found]
    assert [set(filter(None, r.labels.split(","))) for r in found] == [window_labels(t) | b for t, b in zip(texts, base)]


def test_words_far_apart_are_no_notice(spark):
    far = "\n\n".join(f"{w} " + "fish " * 40 for w in license_scan.TEMPLATES[1][1].split())
    assert [r.labels for r in labels(spark, [far, "all\nfish fish fish\nrights\nfish fish\nreserved"])] == ["", ""]
