"""N-gram join, line dedup, decontamination and licenses against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake.llm import decontaminate, license_scan, line_dedup, ngram_join, words


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def gram_set(text, width):
    found = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def brute_components(rows, width, percent):
    """{row number: (set size, smallest doc_id of the component)}."""
    sets = [gram_set(text, width) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in combinations(range(len(rows)), 2):
        if sets[x] and sets[y]:
            shared = len(sets[x] & sets[y])
            if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                root[max(find(x), find(y))] = min(find(x), find(y))
    low = {}
    for x, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(x)] = min(low.get(find(x), doc_id), doc_id)
    return sorted(
        ((d, len(s), d if not s else low.get(find(x))) for x, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


def components(docs, width, percent):
    return sorted(map(tuple, ngram_join.ngram_components(docs, width, percent).collect()), key=str)


def test_ngram_components_of_the_table(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert components(documents, 3, 90) == brute_components(rows, 3, 90)


@pytest.mark.parametrize(("width", "percent"), [(5, 80), (3, 90), (2, 50)])
def test_rare_keys_lose_no_link(spark, documents, edge_docs, no_docs, width, percent):
    docs = documents.select("doc_id", "text").limit(120).unionByName(edge_docs.select("doc_id", "text"))
    near = docs.where("doc_id % 3 = 0").selectExpr("doc_id + 5000 as doc_id", "concat(text, ' and a tail') as text")
    docs = docs.unionByName(near).repartition(4, "text")
    rows = [tuple(r) for r in docs.collect()]
    found = ngram_join.ngram_components(docs, width, percent, route="rare").collect()
    assert sorted(map(tuple, found), key=str) == brute_components(rows, width, percent)
    assert ngram_join.ngram_components(no_docs, route="rare").count() == 0


def test_rare_keys_of_a_pair_meet():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 9, ngram_join.COUNT_PLACES).astype(np.uint64)
    for percent in (50, 80, 90):
        for size in range(1, 60):
            whole = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            other = np.union1d(whole, rng.integers(0, 1 << 63, size * (100 - percent) // percent).astype(np.uint64))
            assert set(ngram_join.rare_keys(whole, percent, counts)) & set(ngram_join.rare_keys(other, percent, counts))


def shared_passages(count):
    """Texts of 70 own words and 30 of one of two passages that many share."""
    rng = random.Random(5)
    passages = [" ".join(f"p{x}w{i}" for i in range(30)) for x in range(2)]
    return [" ".join(f"w{rng.randrange(10**9)}" for _ in range(70)) + " " + passages[at % 2] for at in range(count)]


def test_rare_keys_are_rare_where_places_are_shared(monkeypatch):
    """As in a large corpus, each place of the counts has many n-grams."""
    monkeypatch.setattr(ngram_join, "COUNT_PLACES", 64)
    texts = shared_passages(120)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[low : low + 40])], ["text"]) for low in (0, 40, 80)]
    sent = [row for batch in batches for row in ngram_join._tables(5, iter([batch]))]
    sent = pa.Table.from_batches(sent).sort_by("part").combine_chunks().to_batches()
    parts = sorted(
        (part, *(np.frombuffer(x, kind) for x, kind in zip(row, (np.uint64, np.uint8))))
        for batch in ngram_join._sums(iter(sent))
        for part, *row in zip(*(c.to_pylist() for c in batch.columns))
    )
    counts, common = (np.stack([p[at] for p in parts], axis=axis).ravel() for at, axis in ((1, 1), (2, 0)))
    sets = [np.unique(grams) for batch in batches for _, grams in words.shingle_rows(batch.column(0), 5)]
    expected = np.bincount(np.concatenate(sets).astype(np.int64) & 63, minlength=64)
    assert counts.tolist() == expected.tolist()
    keys = [set(ngram_join.rare_keys(x, 80, counts, common).tolist()) for x in sets]
    assert not any(keys[x] & keys[y] for x in range(120) for y in range(x))


def test_steps_lead_to_their_places():
    rng = np.random.default_rng(2)
    for size, top in ((0, 9), (1, 1), (50, 20), (300, 70_000)):
        places = np.sort(rng.integers(0, top, size))
        assert ngram_join._places(ngram_join._steps(places)).tolist() == places.tolist()


def test_pairs_are_made_where_enough_is_left():
    """Nodes of 100 n-grams: 89 in common are needed at 80 %."""

    def pairs(*rows):
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        batch = pa.RecordBatch.from_arrays(columns, ["key", "node", "reach"])
        found = ngram_join._key_edges(ngram_join.PAIRED, 80, iter([batch]))
        return [e for b in found for e in zip(*(c.to_pylist() for c in b.columns))]

    def reach(size, place):
        return (size << 32) + place + 1

    assert pairs((7, 1, reach(100, 0)), (7, 2, reach(100, 11))) == [(2, 1, False)]
    assert pairs((7, 1, reach(100, 0)), (7, 2, reach(100, 12))) == []
    assert pairs((7, 1, reach(100, 0)), (7, 2, reach(126, 0))) == []
    assert pairs((7, 1, 0), (7, 2, reach(100, 12))) == [(2, 1, True)]


def test_ngram_components_of_edges(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert components(edge_docs, 3, 90) == brute_components(rows, 3, 90)
    assert ngram_join.ngram_components(no_docs).count() == 0


def near_copies(count, seed, length=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for at in range(count):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append((at, " ".join(copy)))
    return out


@pytest.mark.parametrize("percent", [80, 90])
def test_parity_bits_refuse_no_link(percent):
    rng = np.random.default_rng(percent)
    refused = 0
    for size in (1, 3, 40, 500, 530, 4000, 4300):
        for lost in range(0, size // 3 + 1, max(1, size // 40)):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            b = np.concatenate([a[lost:], rng.integers(0, 1 << 63, rng.integers(0, lost + 1), dtype=np.uint64)])
            same, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            bits = ngram_join.parity_bits(a), ngram_join.parity_bits(b)
            may = ngram_join.may_link(*bits, len(a), len(b), percent)
            assert may or 100 * same < percent * either
            refused += not may
        other = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        bits = ngram_join.parity_bits(a), ngram_join.parity_bits(other)
        refused += not ngram_join.may_link(*bits, size, size, percent)
    assert refused > 20


def test_copies_go_by_id_and_text(spark):
    a = " ".join(f"w{i}" for i in range(60))
    near = a.replace("w59", "x59")
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, a), (2, a), (2, other), (None, near), (None, near), (3, "no"), (3, "no"), (4, ""), (4, ""), (5, None)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, root string")
    left = sorted(ngram_join.without_copies(docs).collect(), key=str)
    assert left == sorted([(1, a, "n"), (2, other, "n"), (3, "no", "n"), (4, "", "n"), (4, "", "n"), (5, None, "n")], key=str)
    alone = ngram_join.without_copies(docs.where("doc_id is null")).collect()
    assert [r.text for r in alone] == [near]
    assert ngram_join.without_copies(docs.limit(0)).columns == docs.columns


def test_leaks_go_by_id_and_text(spark):
    item = "the quick brown fox that jumps over a lazy dog near the river bank every morning"
    clean = "another text that nobody asks about, with words enough to make some windows of it"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item), (1, clean), (None, f"so {item}"), (None, clean)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string")
    left = decontaminate.without_leaks(docs, bench).collect()
    assert sorted(map(str, left)) == sorted(map(str, docs.where(f"text = '{clean}'").collect()))


@pytest.mark.parametrize("limit", [1 << 20, 600])
def test_large_groups_are_dealt_without_losing_links(spark, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "TASK_GRAMS", limit)
    monkeypatch.setattr(ngram_join, "PIVOTS", 3)
    rows = near_copies(60, 1) + [(100 + d, t) for d, t in near_copies(12, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert components(docs, 3, 90) == brute_components(rows, 3, 90)


def test_group_links_with_pivots():
    rng = np.random.default_rng(3)
    members = [np.unique(rng.integers(0, 400, 60).astype(np.uint64)) for _ in range(3)]
    for x in list(members):
        for _ in range(40):
            copy = x.copy()
            copy[rng.integers(0, len(x), rng.integers(0, 5))] = rng.integers(1000, 10**6)
            members.append(np.unique(copy))
    found = ngram_join.group_links(members, 80)
    root = list(range(len(members)))
    for x, y in combinations(range(len(members)), 2):
        shared = len(np.intersect1d(members[x], members[y]))
        if 100 * shared >= 80 * (len(members[x]) + len(members[y]) - shared):
            a, b = root[x], root[y]
            root = [min(a, b) if r in (a, b) else r for r in root]
    assert found == root


def test_divide_skip_counts_occurrences():
    rng = random.Random(5)
    for _ in range(200):
        lists = [sorted(rng.sample(range(40), rng.randrange(1, 30))) for _ in range(rng.randrange(1, 12))]
        need = rng.randrange(1, len(lists) + 1)
        expected = [v for v in range(40) if sum(v in x for x in lists) >= need]
        assert ngram_join.divide_skip(lists, need) == expected


def test_word_hashes_split_and_fold_like_the_pattern():
    texts = ["The  cat\tsat", "", None, " a b ", "É é", "x" * 5000]
    for row, grams in words.shingle_rows(pa.array(texts), 1):
        assert len(grams) == len(re.findall(r"[^\x20\x09-\x0D]+", texts[row] or ""))
    (_, a), (_, b) = words.shingle_rows(pa.array(["ABC def", "abc DEF"]), 2)
    assert (a == b).all()


# ------------------------------------------------------------ lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_within_edits(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 12)))
        b = list(a)
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(b) + 1)
            b[at : at + rng.randrange(0, 2)] = rng.choice(["", "a", "é"])
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    for limit in (1, 2, 3):
        found = df.select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), limit).alias("near")).collect()
        assert [r.near for r in found] == [edits(r.a, r.b) <= limit for r in found]


def brute_dropped(rows, min_chars=20):
    """{doc_id: dropped line numbers}; documents of one id count as one."""
    places = {}
    for doc_id, text in rows:
        for number, line in enumerate(text.split("\n") if text is not None else []):
            if len(line.strip(" ")) >= min_chars:
                places.setdefault(line, set()).add((doc_id is not None, doc_id or 0, number))
    first = {line: min(at) for line, at in places.items()}
    ordered = sorted(first, key=len)
    late = set()
    for at, a in enumerate(ordered):
        for b in ordered[at + 1 :]:
            if len(b) - len(a) > 1:
                break
            if edits(a, b) <= 1 and first[a] != first[b]:
                late.add(max(a, b, key=first.get))
    out = {}
    for line, at in places.items():
        for place in at:
            if line in late or place != first[line]:
                out.setdefault(place[1] if place[0] else None, set()).add(place[2])
    return out


def dropped(docs):
    return {r.doc_id: set(r.dropped) for r in line_dedup.dropped_lines(docs).collect()}


def test_lines_of_edges(edge_docs, no_docs):
    rows = [(d, t) for d, t in (tuple(r) for r in edge_docs.select("doc_id", "text").collect()) if len(t or "") < 1000]
    short = edge_docs.where("text is null or char_length(text) < 1000")
    assert dropped(short) == brute_dropped(rows)
    kept = line_dedup.dedup_lines(edge_docs)
    assert kept.count() == edge_docs.count()
    assert set(edge_docs.columns) < set(kept.columns)
    assert line_dedup.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("split_over", [64, 2])
def test_lines_within_one_edit(spark, monkeypatch, split_over):
    monkeypatch.setattr(line_dedup, "SPLIT_OVER", split_over)
    rng = random.Random(4)
    stems = ["entry number of the long common list is", "page of the book that everybody has read"]
    lines = []
    for _ in range(150):
        line = list(rng.choice(stems) + f" {rng.randrange(30)}")
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(line))
            line[at : at + rng.randrange(2)] = rng.choice(["x", "yz", ""])
        lines.append("".join(line))
    rows = [(d, "\n".join(lines[d * 5 : d * 5 + 5])) for d in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dropped(docs) == brute_dropped(rows)
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    gone = brute_dropped(rows)
    for doc_id, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if n not in gone.get(doc_id, ())]
        assert texts[doc_id] == "\n".join(kept)


# ------------------------------------------------------------ decontamination

ITEM = "yesterday evening our friend Alice bought 12 kg of apples at the market and gave 3 of them to Bob before dinner"


def leaks(spark, texts, items=(ITEM,), ids=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r.kind for r in decontaminate.leaks(docs, bench).collect()}


def test_reparameterised_items_are_found_and_inconsistent_slots_are_not(spark):
    same = "Intro. " + ITEM + ". More text."
    other = ITEM.replace("12 kg", "45 km").replace("Alice", "Carol").replace("Bob", "David")
    twice = "we saw that 7 of the boxes held 7 red balls while 7 more were lost on the way home"
    uneven = twice.replace("7", "8", 1)
    found = leaks(spark, [same, other, "nothing of the kind is here at all, dear reader", uneven], (ITEM, twice))
    assert found == {(0, 0): "verbatim", (1, 0): "reparameterised"}


def test_short_items_are_sentences_or_have_their_own_values(spark):
    texts = ["She asked what is 5 doing here", "I see what is 9", "Hello. What is 3 + 4? Bye", "so what is 12 + 7 then", "What is 8"]
    assert leaks(spark, texts, ("What is 12 + 7?",)) == {(2, 0): "reparameterised", (3, 0): "verbatim", (4, 0): "reparameterised"}


def test_leaks_match_a_search_for_the_items(spark, documents, sf_dir):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(documents, bench).collect()}
    items = [(r.item_id, r.text) for r in bench.collect()]
    whole = {(d.doc_id, i) for d in documents.collect() for i, text in items if text in (d.text or "")}
    assert whole <= found
    assert len(found) <= 1.1 * len(whole) + 1


def test_leaks_of_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, None, 2), (2, "", 3), (None, ITEM, 4), (3, "one", 5), (4, "the cat sat on the mat and then it went away", 6)], "item_id long, text string, hash long")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(edge_docs, bench).collect()} == {(1, 4)}  # a number alone is no template
    assert decontaminate.leaks(no_docs, bench).count() == 0
    assert decontaminate.leaks(edge_docs, bench.limit(0)).count() == 0


# ------------------------------------------------------------ licenses


def base_scan(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(found) - len(parts) + 1) if found[i : i + len(parts)] == parts]
        starts += at
        labels |= {label} if at else set()
    return (len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def block_labels(text):
    """Labels of all templates that a line contains well enough."""
    out = set()
    for line in (text or "").split("\n"):
        have = set(license_scan._template_words(re.sub(license_scan.BETWEEN, " ", line)))
        for label, template in license_scan.TEMPLATES:
            need = set(license_scan._template_words(template))
            if len(have & need) >= license_scan.THRESHOLD * len(need):
                out.add(label)
    return out


LICENSED = [
    "MIT License, mit license; Apache-License and GNU GENERAL  public\nlicense",
    "Released under the MIT License.\nLicensed under the Apache License, Version 2.0, more or less",
    "licensed under CC BY-NC 4.0!\nAll rights reserved",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the Software without restriction",
    "the mit licence\nlİcense mit",
    "released under the license",
]


def test_scan_against_brute_force(spark, documents, edge_docs, no_docs):
    extra = spark.createDataFrame(list(enumerate(LICENSED, 10**6)), "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(edge_docs.select("doc_id", "text")).unionByName(extra)
    found = license_scan.scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"
    )
    expected = []
    for r in docs.collect():
        base = base_scan(r.text)
        every = block_labels(r.text) | set(filter(None, base[-1].split(",")))
        expected.append((r.doc_id, *base, ",".join(sorted(every))))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert license_scan.scan(no_docs).count() == 0
