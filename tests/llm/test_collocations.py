"""Phrase mining against SQL on the given tables and plain counting on small ones."""

import random
import re
from collections import Counter

import oracle
import pytest

from eventlake.llm import collocations, queries

COLUMNS = "lang rank phrase a l r n score".split()


def plain(docs, support, top):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts.update((lang, " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {x: f for x, f in counts.items() if f >= support and " " in x[1]}
    holders = {}
    for (lang, p), f in frequent.items():
        w = p.split(" ")
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    holders.setdefault((lang, " ".join(w[i:j])), []).append(f)
    out = []
    for (lang, phrase), a in frequent.items():
        w = phrase.split(" ")
        cuts = []
        for k in range(1, len(w)):
            l, r = counts[lang, " ".join(w[:k])], counts[lang, " ".join(w[k:])]
            cuts.append((2000000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        longer = [f for f in holders.get((lang, phrase), []) if 100 * f >= 80 * a]
        if not longer:
            out.append((lang, -score, -a, phrase.encode(), (phrase, a, l, r, totals[lang], score)))
    rows, rank = [], Counter()
    for lang, _, _, _, rest in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], *rest))
    return sorted(rows)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_query_equals_sql(spark, sf_dir):
    name = "op13_collocations"
    sql = oracle.expected(oracle.connect(sf_dir), queries.oracle_sql()[name])
    assert sql[1]
    assert oracle.actual(queries.queries()[name](spark, sf_dir)) == sql


@pytest.mark.parametrize("shards, bits", [(1, 20), (3, 6), (5, 20)])
def test_shards_and_full_filters_change_nothing(spark, shards, bits):
    """With 64 bits nearly every bit is set, so nothing is pruned."""
    draw = random.Random(shards)
    signs = [" "] * 20 + [".", ", ", "\t", "\n", "  "]
    texts = []
    for i in range(120):
        text = "".join(draw.choice(["New", "york", "city", "a", "b", "É", "x_y"]) + draw.choice(signs) for _ in range(60))
        texts.append((i if i % 9 else None, draw.choice(["en", "fr", None, ""]), text if i % 17 else None))
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(5)
    expected = plain([t[1:] for t in texts], 12, 40)
    assert expected
    assert found(collocations.collocations(docs, 12, 40, shards, bits)) == expected


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert found(collocations.collocations(edge_docs, 2, 50, filter_bits=20)) == plain(rows, 2, 50)
    assert collocations.collocations(no_docs, filter_bits=20).count() == 0


def test_repeated_words_and_rows(spark):
    rows = [(1, "en", "ha ha ha ha ha")] * 7 + [(2, "en", "Ha HA ha. ha ha")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert found(collocations.collocations(docs, 3, 10, filter_bits=20)) == plain([r[1:] for r in rows], 3, 10)
