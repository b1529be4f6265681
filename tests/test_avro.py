import base64
import json
import math
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from slow_avro import encode, frame

from eventlake import ack, avro, envelope
from eventlake.functions.avro_read import Cursors, read_rows, reader
from eventlake.functions.avro_write import varints, writer


def record(*fields, name="R", **extra):
    return {
        "type": "record",
        "name": name,
        "fields": [{"name": n, "type": t} for n, t in fields],
        **extra,
    }


def decoded(spark, frames, schemas, drop=(), **options):
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(frames)], "i int, value binary")
    store = spark.createDataFrame(
        [(str(i), s if isinstance(s, str) else json.dumps(s)) for i, s in schemas.items()],
        "schema_id string, body string",
    )
    out = avro.decode_events(envelope.add_header(rows), store, drop, **options)
    found = sorted((r.i, r.events, r.decode_error) for r in out.collect())
    return [(e and base64.b64decode(e).decode(), error) for _, e, error in found]


TYPES = [
    ("long", -1, -1),
    ("long", 2**63 - 1, 2**63 - 1),
    ("long", -(2**63), -(2**63)),
    ("int", 300, 300),
    ("boolean", True, True),
    ("null", None, None),
    ("float", 1.5, 1.5),
    ("double", 0.1, 0.1),
    ("string", 'é "q" 😀', 'é "q" 😀'),
    ("string", "", ""),
    ("bytes", b"\0\xff", "AP8="),
    ({"type": "fixed", "name": "F", "size": 2}, b"ab", "YWI="),
    ({"type": "enum", "name": "E", "symbols": ["A", "B"]}, "B", "B"),
    (["null", "string"], (0, None), None),
    (["null", "string"], (1, "x"), "x"),
    (["long", "string", "null"], (1, "x"), "x"),
    ({"type": "array", "items": "long"}, [1, 2], "[1, 2]"),
    ({"type": "array", "items": "long"}, [], None),
    ({"type": "array", "items": {"type": "array", "items": "string"}}, [["a"], []], '[["a"], []]'),
    ({"type": "int", "logicalType": "date"}, 19_000, "2022-01-08"),
    ({"type": "int", "logicalType": "time-millis"}, 3_600_001, "01:00:00.001000"),
    ({"type": "long", "logicalType": "timestamp-millis"}, 1, "1970-01-01T00:00:00.001000+00:00"),
    ({"type": "long", "logicalType": "timestamp-micros"}, -1, "1969-12-31T23:59:59.999999+00:00"),
    ({"type": "long", "logicalType": "timestamp-micros"}, 2**62, str(2**62)),
    ({"type": "bytes", "logicalType": "decimal", "precision": 5, "scale": 2}, b"\xfe\x0c", "-5.00"),
    ({"type": "string", "logicalType": "uuid"}, "u", "u"),
]


def test_every_type(spark):
    frames = [frame(i, record(("f", s)), {"f": v}) for i, (s, v, _) in enumerate(TYPES)]
    schemas = {i: record(("f", s)) for i, (s, _, _) in enumerate(TYPES)}
    expected = [(json.dumps({"f": shown}), None) for *_, shown in TYPES]
    assert decoded(spark, frames, schemas) == expected
    assert decoded(spark, frames, schemas, max_schema_bytes=0) == expected


def test_not_a_number(spark):
    schema = record(("a", "double"), ("b", "double"))
    frames = [frame(1, schema, {"a": math.nan, "b": -math.inf})]
    assert decoded(spark, frames, {1: schema}) == [('{"a": NaN, "b": -Infinity}', None)]


USER = record(("id", "long"), ("name", ["null", "string"]), name="User")
NESTED = record(
    ("user", USER),
    ("friend", ["null", "User"]),
    ("friends", {"type": "array", "items": "User"}),
    ("labels", {"type": "map", "values": "long"}),
)


def test_nested_maps_and_named_types(spark):
    event = {
        "user": {"id": 1, "name": (1, "a")},
        "friend": (1, {"id": 2, "name": (0, None)}),
        "friends": [{"id": 3, "name": (0, None)}],
        "labels": {"x": 5, "y": 6},
    }
    bare = {"user": {"id": 9, "name": (0, None)}, "friend": (0, None), "friends": [], "labels": {}}
    assert decoded(spark, [frame(4, NESTED, event), frame(4, NESTED, bare)], {4: NESTED}) == [
        (
            '{"user_id": 1, "user_name": "a", "friend_id": 2, "friend_name": null, '
            '"friends": "[{\\"id\\": 3, \\"name\\": null}]", "labels_x": 5, "labels_y": 6}',
            None,
        ),
        ('{"user_id": 9, "user_name": null, "friend": null, "friends": null}', None),
    ]


@pytest.mark.parametrize("extra", [(), (("m", {"type": "map", "values": "long"}),)])
def test_collision_and_dropped_keys(spark, extra):
    schema = record(("a", record(("b", "long"), ("c", "long"), name="A")), ("a_b", "long"), *extra)
    event = {"a": {"b": 1, "c": 2}, "a_b": 3, "m": {}}
    frames = [frame(1, schema, event)]
    assert decoded(spark, frames, {1: schema}) == [('{"a_b": 3, "a_c": 2}', None)]
    assert decoded(spark, frames, {1: schema}, ["a.c"]) == [('{"a_b": 3}', None)]
    assert decoded(spark, frames, {1: schema}, ["a", "a_b"]) == [("{}", None)]
    assert decoded(spark, frames, {1: schema}, ["x.y", "a.b.z"]) == [('{"a_b": 3, "a_c": 2}', None)]


def test_percent_sign_in_a_name_survives(spark):
    schema = record(("50%", "long"), ("%s", "long"))
    assert decoded(spark, [frame(1, schema, {"50%": 1, "%s": 2})], {1: schema}) == [
        ('{"50%": 1, "%s": 2}', None)
    ]


def test_top_level_that_is_not_a_record(spark):
    schemas = {1: "long", 2: {"type": "map", "values": "long"}}
    schemas = {i: json.dumps(s) for i, s in schemas.items()}
    frames = [frame(1, "long", 5), frame(2, {"type": "map", "values": "long"}, {"a": 1})]
    assert decoded(spark, frames, schemas) == [("null", None), ('{"a": 1}', None)]


FLAT = record(("id", "long"), ("name", "string"))
GOOD = frame(3, FLAT, {"id": 1, "name": "abc"})
TEXT = '{"id": 1, "name": "abc"}'


@pytest.mark.parametrize("options", [{}, {"max_schema_bytes": 0}])
def test_damaged_frames(spark, options):
    huge = GOOD[:6] + b"\xfe\xff\xff\xff\xff\xff\xff\xff\xff\x01"
    frames = {
        GOOD: (TEXT, None),
        GOOD + b"trailing": (TEXT, None),
        b"\1" + GOOD[1:]: (TEXT, "bad_magic"),
        GOOD[:-1]: ('{"3": -1}', "bad_body"),
        GOOD[:5]: ('{"3": -1}', "bad_body"),
        huge: ('{"3": -1}', "bad_body"),
        GOOD[:5] + b"\xff" * 12: ('{"3": -1}', "bad_body"),
        GOOD[:7] + b"\xff\xfe\xfd": ('{"3": -1}', "bad_body"),
        b"\0\0\0\0\4" + GOOD[5:]: ('{"4": -1}', "unknown_schema"),
        b"\0\0\0\0\5" + GOOD[5:]: ('{"5": -1}', "unknown_schema"),
        b"\0\1": ('{"null": -1}', "short_frame"),
        b"": ('{"null": -1}', "short_frame"),
        None: (None, None),
    }
    schemas = {3: FLAT, 5: '{"type": "nonsense"}'}
    assert decoded(spark, list(frames), schemas, **options) == list(frames.values())


def test_damage_in_every_type_is_contained(spark):
    frames = [frame(i, record(("f", s)), {"f": v}) for i, (s, v, _) in enumerate(TYPES)]
    schemas = {i: record(("f", s)) for i, (s, _, _) in enumerate(TYPES)}
    cut = [f[:-1] if len(f) > 5 else f for f in frames]
    for (text, error), whole in zip(decoded(spark, cut, schemas), frames):
        assert (error == "bad_body") == (len(whole) > 5), (text, error, whole)


def test_a_deeply_nested_row_spoils_only_itself(spark):
    schema = record(("next", ["null", "R"]), ("v", "long"))
    node = b"\2" * 50_000 + b"\0" + b"\2" * 50_001
    shallow = struct.pack(">bI", 0, 1) + b"\2\0\2\4"
    out = decoded(spark, [shallow, struct.pack(">bI", 0, 1) + node, shallow], {1: schema})
    assert out == [
        ('{"next_next": null, "next_v": 1, "v": 2}', None),
        ('{"1": -1}', "bad_body"),
        ('{"next_next": null, "next_v": 1, "v": 2}', None),
    ]


def test_one_hot_schema_among_many(spark):
    schemas = {i: record(("id", "long"), (f"name_{i}", "string")) for i in range(40)}
    ids = [0] * 400 + list(range(40))
    frames = [frame(s, schemas[s], {"id": n, f"name_{s}": "x" * n}) for n, s in enumerate(ids)]
    expected = [(json.dumps({"id": n, f"name_{s}": "x" * n}), None) for n, s in enumerate(ids)]
    assert decoded(spark, frames, schemas) == expected
    assert decoded(spark, frames, schemas, max_schema_bytes=0) == expected


def test_store_above_the_bound_is_cut_to_the_ids_in_use(spark):
    schemas = {i: record(("id", "long"), (f"name_{i}", "string")) for i in range(100)}
    frames = [frame(7, schemas[7], {"id": 1, "name_7": "x"})]
    size = len(json.dumps(schemas[7])) + 1
    assert decoded(spark, frames, schemas, max_schema_bytes=size) == [
        ('{"id": 1, "name_7": "x"}', None)
    ]


def test_wide_arrow_types(spark):
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        test_damaged_frames(spark, {})
        test_encode_events_frames_structs_and_maps(spark)
        test_every_type(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.useLargeVarTypes")


@pytest.mark.parametrize("options", [{}, {"max_schema_bytes": 0}])
def test_streams_decode_through_either_route(spark, tmp_path, options):
    frames = [(GOOD,), (GOOD[:-1],)]
    spark.createDataFrame(frames, "value binary").write.parquet(str(tmp_path / "in"))
    store = spark.createDataFrame([("3", json.dumps(FLAT))], "schema_id string, body string")
    stream = spark.readStream.schema("value binary").parquet(str(tmp_path / "in"))
    out = avro.decode_events(envelope.add_header(stream), store, **options)
    name = f"decoded_{len(options)}"
    query = out.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    errors = [r.decode_error for r in spark.table(name).orderBy("decode_error").collect()]
    assert errors == [None, "bad_body"]


def test_split_errors_keeps_every_row(spark):
    rows = spark.createDataFrame([(GOOD,), (GOOD[:-1],), (None,)], "value binary")
    store = spark.createDataFrame([("3", json.dumps(FLAT))], "schema_id string, body string")
    good, bad = avro.split_errors(avro.decode_events(envelope.add_header(rows), store))
    assert good.count() == 2
    assert [bytes(r.value) for r in bad.collect()] == [GOOD[:-1]]


def test_header_columns_are_required(spark):
    rows = spark.createDataFrame([(GOOD,)], "value binary")
    with pytest.raises(ValueError, match="add_header"):
        avro.decode_events(rows, rows)


# ---------------------------------------------------------------- encode

PAYLOAD = record(
    ("id", "long"),
    ("ok", "boolean"),
    ("x", "double"),
    ("y", "float"),
    ("name", ["null", "string"]),
    ("raw", ["bytes", "null"]),
    ("kind", {"type": "enum", "name": "K", "symbols": ["a", "b"]}),
    ("tags", {"type": "array", "items": "string"}),
    ("inner", record(("n", "int"), name="I")),
)
PAYLOAD_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("ok", pa.bool_()),
        ("x", pa.float64()),
        ("y", pa.float32()),
        ("name", pa.string()),
        ("raw", pa.binary()),
        ("kind", pa.string()),
        ("tags", pa.list_(pa.string())),
        ("inner", pa.struct([("n", pa.int32())])),
    ]
)
payloads = st.fixed_dictionaries(
    {
        "id": st.integers(-(2**63), 2**63 - 1),
        "ok": st.booleans(),
        "x": st.floats(),
        "y": st.floats(width=32),
        "name": st.none() | st.text(),
        "raw": st.none() | st.binary(),
        "kind": st.sampled_from(["a", "b"]),
        "tags": st.lists(st.text(max_size=80), max_size=3),
        "inner": st.fixed_dictionaries({"n": st.integers(-(2**31), 2**31 - 1)}),
    }
)


@settings(max_examples=100, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(payloads, min_size=1, max_size=6))
def test_encode_matches_slow_encoder_and_decodes_back(events):
    array = pa.array(events, pa.struct(list(PAYLOAD_ARROW)))
    bodies = writer(PAYLOAD)(array)

    def tagged(e):
        return e | {
            "name": (0, None) if e["name"] is None else (1, e["name"]),
            "raw": (1, None) if e["raw"] is None else (0, e["raw"]),
        }

    assert bodies == [encode(PAYLOAD, tagged(e)) for e in events]
    cursors = Cursors(pa.array(bodies, pa.binary()), 0)
    back = read_rows(reader(PAYLOAD), cursors, np.arange(len(events)))
    assert not cursors.bad.any()
    assert (cursors.pos == cursors.end).all()
    ordered = [{name: e[name] for name in PAYLOAD_ARROW.names} for e in events]
    shown = [
        e | {"raw": e["raw"] if e["raw"] is None else base64.b64encode(e["raw"]).decode()}
        for e in ordered
    ]
    assert repr(back) == repr(shown)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=1, max_size=8))
def test_arbitrary_bytes_never_raise(bodies):
    for schema in (PAYLOAD, NESTED):
        cursors = Cursors(pa.array(bodies, pa.binary()), 0)
        assert len(read_rows(reader(schema), cursors, np.arange(len(bodies)))) == len(bodies)
        assert (cursors.pos <= cursors.end).all()


@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1))
def test_varints(numbers):
    bodies = varints(np.array(numbers, np.int64))
    assert bodies == [encode("long", n) for n in numbers]


def test_encode_events_frames_structs_and_maps(spark):
    df = spark.createDataFrame([("1", None), ("2", "bad")], "event_id string, errors string")
    schema = record(("event_id", "string"), ("errors", ["null", "string"]))
    df = df.select(ack.ack_payload().alias("s"), ack.ack_payload_map().alias("m"))
    both = avro.encode_events(df, "s", 2**32 - 1, json.dumps(schema), into="from_struct")
    both = avro.encode_events(both, "m", 2**32 - 1, schema, into="from_map")
    for row, value in zip(both.collect(), [(0, None), (1, "bad")]):
        expected = frame(2**32 - 1, schema, {"event_id": row.s.event_id, "errors": value})
        assert bytes(row.from_struct) == bytes(row.from_map) == expected


def test_encode_uses_defaults_and_rejects_nulls(spark):
    schema = {
        "type": "record",
        "name": "R",
        "fields": [{"name": "id", "type": "long"}, {"name": "v", "type": "long", "default": 5}],
    }
    df = spark.createDataFrame([(1,), (None,)], "id long").select(F.struct("id").alias("s"))
    filled = avro.encode_events(df.filter("s.id = 1"), "s", 1, schema).first()
    assert bytes(filled.value) == frame(1, schema, {"id": 1, "v": 5})
    with pytest.raises(Exception, match="null value"):
        avro.encode_events(df, "s", 1, schema).collect()


def read_one(schema, body):
    cursors = Cursors(pa.array([body], pa.binary()), 0)
    return read_rows(reader(schema), cursors, np.array([0]))[0], bool(cursors.bad[0])


@pytest.mark.parametrize(
    ("items", "value"),
    [
        ("null", None),
        ({"type": "record", "name": "E", "fields": []}, {}),
        ({"type": "fixed", "name": "F", "size": 0}, ""),
    ],
)
def test_items_of_no_bytes(items, value):
    array = {"type": "array", "items": items}
    assert read_one(array, b"\x0a\x00") == ([value] * 5, False)
    hostile = varints(np.array([1 << 40]))[0]
    assert read_one(array, hostile + b"\x00")[1]


def test_a_named_type_of_no_bytes_as_items():
    schema = record(
        ("a", {"type": "record", "name": "E", "fields": []}),
        ("b", {"type": "array", "items": "E"}),
    )
    assert read_one(schema, b"\x06\x00") == ({"a": {}, "b": [{}, {}, {}]}, False)


def test_decimals_keep_every_digit():
    number = -(10**12_000 + 7)
    raw = number.to_bytes(number.bit_length() // 8 + 1, "big", signed=True)
    body = varints(np.array([len(raw)]))[0] + raw
    text, bad = read_one({"type": "bytes", "logicalType": "decimal", "precision": 12_001, "scale": 2}, body)
    assert not bad
    assert text == "-1" + "0" * 11_997 + "0" + ".07"
    assert read_one({"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 3}, b"\x02\x05")[0] == "0.005"


def test_long_runs_of_numbers():
    numbers = [(-1) ** n * n * 7919 for n in range(200_000)]
    array = {"type": "array", "items": "long"}
    body = encode(array, numbers)
    assert read_one(array, body) == (numbers, False)
    assert read_one(array, body[:-50])[1]
    doubles = {"type": "array", "items": "double"}
    assert read_one(doubles, encode(doubles, [n / 3 for n in range(500)])) == ([n / 3 for n in range(500)], False)


def _numbered_store(spark, n):
    schema = record(("a", "int")) | {"doc": f"version {n}"}
    return spark.createDataFrame([("3", json.dumps(schema))], "schema_id string, body string")


def test_frames_outlive_any_number_of_other_stores(spark):
    rows = envelope.add_header(spark.createDataFrame([(b"\0\0\0\0\3\2",)], "value binary"))
    frames = [avro.decode_events(rows, _numbered_store(spark, n)) for n in range(20)]
    assert [f.select("decode_error").first()[0] for f in (frames[0], frames[-1])] == [None, None]


def test_a_stream_holds_the_stores_of_one_batch(spark):
    rows = envelope.add_header(spark.createDataFrame([(b"\0\0\0\0\3\2",)], "value binary"))
    stores = avro.BatchStores()
    shared = dict(avro._SHARED)
    for n in range(20):
        with stores.batch():
            decoded_ = avro.decode_events(rows, _numbered_store(spark, n // 2))
            assert decoded_.select("decode_error").first()[0] is None
        assert len(stores.held) == 1
    assert avro._SHARED == shared


def _cogrouped(spark, frames, schemas, **options):
    rows = spark.createDataFrame([(n, f) for n, f in enumerate(frames)], "n int, value binary").repartition(4)
    store = spark.createDataFrame([(str(k), json.dumps(v)) for k, v in schemas.items()], "schema_id string, body string")
    return avro.decode_events(envelope.add_header(rows), store, max_schema_bytes=0, **options)


@pytest.mark.parametrize("group_rows", [1, 7, 1 << 19])
def test_groups_of_any_size_decode_alike(spark, group_rows):
    """A hot id, an unknown one, and frames without an id, each in as many groups as it needs."""
    schemas = {i: record(("id", "long")) for i in range(3)}
    frames = [frame(0 if n % 3 else n % 2 + 1, schemas[0], {"id": n}) for n in range(90)]
    frames += [b"\0\0\0\0\x63\2", b"\0\1", b"\0\2", None, None, b"\0\0\0\0\0"]
    rows = _cogrouped(spark, frames, schemas, group_rows=group_rows).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(len(frames)))
    assert [r["decode_error"] for r in rows[:90]] == [None] * 90
    errors = ["unknown_schema", "short_frame", "short_frame", None, None, "bad_body"]
    assert [r["decode_error"] for r in rows[90:]] == errors


def test_a_group_shuffles_rows_once_and_without_documents(spark):
    schemas = {i: record(("id", "long")) for i in range(3)}
    df = _cogrouped(spark, [frame(n % 3, schemas[0], {"id": n}) for n in range(9)], schemas)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    _, tree = plan.split("FlatMapCoGroupsInArrow", 1)
    # The rows' side comes first: the written rows, the broadcast sizes, nothing of source or documents.
    messages = tree[tree.index("\n") : tree.index("\n   +- ")]
    assert messages.count("] parquet") == 2 and "strategy=broadcast" in messages
    assert "body" not in messages and "LogicalRDD" not in messages


def test_rows_that_cannot_be_encoded_are_marked_and_the_others_kept(spark):
    """Nulls at the top, in a nested record, in an array's items; a symbol that the enum has not."""
    inner = {"type": "record", "name": "In", "fields": [{"name": "x", "type": "long"}]}
    schema = {
        "type": "record",
        "name": "Out",
        "fields": [
            {"name": "a", "type": "string"},
            {"name": "in", "type": ["null", inner]},
            {"name": "l", "type": {"type": "array", "items": "string"}},
            {"name": "k", "type": {"type": "enum", "name": "K", "symbols": ["u", "v"]}},
        ],
    }
    ddl = "n int, s struct<a: string, in: struct<x: bigint>, l: array<string>, k: string>"
    rows = [
        (0, ("p", (1,), ["x", "y"], "u")),
        (1, (None, (1,), [], "u")),
        (2, ("p", (None,), [], "u")),
        (3, ("p", None, ["x", None], "u")),
        (4, ("p", None, [], "w")),
        (5, None),
        (6, ("q", None, [], "v")),
    ]
    framed = avro.encode_events(spark.createDataFrame(rows, ddl), "s", 5, schema, error="why").orderBy("n").collect()
    assert [r["why"] for r in framed] == [None, *["bad_value"] * 4, None, None]
    assert [r["value"] is None for r in framed] == [False, *[True] * 5, False]
    assert bytes(framed[0]["value"]) == frame(5, schema, {"a": "p", "in": (1, {"x": 1}), "l": ["x", "y"], "k": "u"})


def test_empty_rows_decode_to_nothing(spark):
    assert _cogrouped(spark, [], {1: record(("id", "long"))}).count() == 0
