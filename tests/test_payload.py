import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake import payload, transforms


def flattened(spark, texts, drop=()):
    raws = [t.encode() if isinstance(t, str) else t for t in texts]
    df = spark.createDataFrame([(i, raw) for i, raw in enumerate(raws)], "i int, v binary")
    rows = df.select("i", payload.flatten_text(F.col("v"), drop).alias("f")).collect()
    return [row.f and bytes(row.f).decode() for row in sorted(rows)]


CASES = [
    ('{"a":{"b":{"c":1}}}', (), '{"a_b_c": 1}'),
    ('{"a":[]}', (), '{"a": null}'),
    ('{"a":[1,{"b":2}]}', (), '{"a": "[1, {\\"b\\": 2}]"}'),
    ('{"a":{}}', (), "{}"),
    ('{"a":{"b":1},"a_b":2}', (), '{"a_b": 2}'),
    ('{"a_b":2,"c":0,"a":{"b":1}}', (), '{"a_b": 1, "c": 0}'),
    ('{"a":"é"}', (), '{"a": "\\u00e9"}'),
    ('{"":{"b":1},"c":{"":{"d":2}}}', (), '{"b": 1, "c__d": 2}'),
    ('{"a":1.0,"b":1e400,"c":12345678901234567890123}', (), '{"a": 1.0, "b": Infinity, "c": 12345678901234567890123}'),
    ('{"a":{"b":1,"c":2}}', ("a.b",), '{"a_c": 2}'),
    ('{"a":{"b":1}}', ("a.b",), "{}"),
    ('{"a":1}', ("x.y",), '{"a": 1}'),
    ('{"l":[{"k":1}]}', ("l.k",), '{"l": "[{\\"k\\": 1}]"}'),
    ('{"s":"text"}', ("s.k", "s.k.m"), '{"s": "text"}'),
    ("not json", (), None),
    ("[1, 2]", (), None),
    ("", (), None),
    (None, (), None),
    ("[" * 100_000, (), None),
    (b"\xff\xfe\x00", (), None),
    ('{"a":1}'.encode("utf-16"), (), '{"a": 1}'),
    ('{"a":1}'.encode("utf-16-le"), (), '{"a": 1}'),
    ('{"a":1}'.encode("utf-8-sig"), (), '{"a": 1}'),
    (b' \n{"a":"\xed\xa0\x80"} ', (), '{"a": "\\ud800"}'),
    (b'{"a":"\xff"}', (), None),
    ('{"a":1} x', (), None),
    ('{"a":NaN,"a":2}', (), '{"a": 2}'),
]


@pytest.mark.parametrize("text, drop, expected", CASES, ids=range(len(CASES)))
def test_flatten_text(spark, text, drop, expected):
    assert flattened(spark, [text], drop) == [expected]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=3), inner, max_size=3),
    max_leaves=12,
)


def slow_flatten(node, prefix=()):
    """Paths to leaves as a list of pairs, without any sharing of the real code."""
    if isinstance(node, dict):
        return [leaf for key, child in node.items() for leaf in slow_flatten(child, (*prefix, key))]
    return [(prefix, node)]


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text(min_size=1, max_size=3), json_values, max_size=4))
def test_flatten_keeps_every_leaf(event):
    expected = {}
    for path, leaf in slow_flatten(event):
        name = path[0]
        for part in path[1:]:
            name += "_" + part
        if isinstance(leaf, list):
            leaf = json.dumps(leaf) if leaf else None
        expected[name] = leaf
    text = payload.flat_json(json.loads(json.dumps(event)))
    assert text == json.dumps(expected)
    assert payload.flat_json(json.loads(text)) == text


def test_flatten_struct_agrees_with_text(spark):
    df = spark.sql(
        "select named_struct('a', named_struct('b', 1, 'c', array('x', 'y')), 'd', array(), 'e', 'é') s, 7 k"
    )
    flat = payload.flatten_struct(df, "s")
    assert flat.columns == ["k", "a_b", "a_c", "d", "e"]
    text = df.select(payload.flatten_text(F.to_json("s")).alias("f")).first().f
    typed = flat.drop("k").first().asDict()
    typed["a_c"] = json.dumps(json.loads(typed["a_c"]))
    assert json.loads(bytes(text)) == typed


def test_flatten_struct_drops_paths_and_resolves_collisions(spark):
    df = spark.sql("select named_struct('a', named_struct('b', 1), 'a_b', 2, 'c', named_struct('d', 3)) s")
    assert payload.flatten_struct(df, "s", ["c.d", "x.y"]).first().asDict() == {"a_b": 2}


def test_flatten_struct_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.sql("select named_struct('a', named_struct('b', 1, 'c', 2)) s").write.parquet(path)
    plan = payload.flatten_struct(spark.read.parquet(path), "s").select("a_b")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<s:struct<a:struct<b:int>>>" in text


def test_bad_json_is_kept_and_marked(spark):
    rows = [(b"k", b'{"a":{"b":1}}'), (b"k", b"{oops"), (b"k", None)]
    df = spark.createDataFrame(rows, "key binary, value binary").selectExpr(
        "*", "'t' topic", "0 partition", "0L offset", "timestamp'2024-01-01' timestamp", "0 timestampType"
    )
    good, bad, null = transforms.decode_json(df, as_of="timestamp").collect()
    assert bytes(good.value) == b'{"a_b": 1}'
    assert good.kafka_metadata_hashed_payload == hashlib.sha256(b'{"a_b": 1}').hexdigest()
    assert good.payload_sha256 == hashlib.sha256(b'{"a":{"b":1}}').hexdigest()
    assert good.decode_error is None
    assert (bytes(bad.value), bad.events, bad.decode_error) == (b"{oops", None, "bad_json")
    assert (null.value, null.events, null.decode_error) == (None, None, None)
