"""The filter audit against SQL on the given tables and a plain walk through all orders on small ones."""

from itertools import permutations

import oracle
import pytest

from eventlake.llm import filter_audit, queries

COUNTS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def plain(docs, labels):
    """Each order applied to each document, one after the other."""
    import re

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        rows.append((lang or "", fails, i in good, i in toxic))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[1]]
                failing = [r for r in rows if r[0] == part and f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), len(failing) - len(here), sum(r[1] == {f} for r in failing),
                    sum(r[2] for r in here), sum(r[3] for r in here),
                ]
    return {k: tuple([*v, shapley[k[0], k[1][k[2] - 1]]]) for k, v in out.items()}


def found(docs, labels):
    rows = filter_audit.audit(docs, labels).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in rows}


def test_query_equals_sql(spark, sf_dir):
    name = "op11_filter_audit"
    sql = oracle.expected(oracle.connect(sf_dir), queries.oracle_sql()[name])
    assert oracle.actual(queries.queries()[name](spark, sf_dir)) == sql


def test_intervals_tile_all_orders_that_remove_a_mask():
    for mask in range(1, 32):
        ranks = sorted(r for _, begin, end in filter_audit.intervals(mask) for r in range(begin, end))
        assert ranks == list(range(120))
    assert filter_audit.intervals(0) == []


def test_edges_equal_a_walk_through_all_orders(spark, edge_docs):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in edge_docs.collect()]
    long = " ".join(f"w{i}" for i in range(250))
    docs += [(20, long, "en"), (19, long, "fr"), (21, long + " $", ""), (22, "A " * 300, "fr"), (22, "A " * 300, "en")]
    docs += [(None, long, "en"), (None, long, "en"), (23, long + "\x1c&", "xx")]
    labels = [(20, 1, 0), (20, 0, 1), (19, None, 1), (None, 1, 1), (5, 1, None), (22, 1, 1), (99, 1, 1)]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, lang string, mask string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found(table, marks) == plain(docs, labels)


def test_without_rows_and_labels(spark, no_docs, edge_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, none).count() == 0
    rows = found(edge_docs, none)
    assert len(rows) == 600 * len({key[0] for key in rows})
    assert not any(v[4] or v[5] for v in rows.values())


@pytest.mark.parametrize("column", ["kept", "shapley"])
def test_types(spark, no_docs, column):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert dict(filter_audit.audit(no_docs, none).dtypes)[column] == "bigint"
