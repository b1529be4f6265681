import json

import pytest

from eventlake import registry


def put(root, path, body):
    file = root / path / "schema.json"
    file.parent.mkdir(parents=True)
    file.write_text(body)


def store(root, spark):
    put(root, "schema_id/3", '{"type":\n "long"}')
    put(root, "schema_id/11", '"string"')
    put(root, "schema_id/12", "{broken")
    (root / "schema_id/3/notes.txt").write_text("not a schema")
    return str(root)


def test_schema_store(spark, tmp_path):
    rows = registry.read_schema_store(spark, store(tmp_path, spark)).collect()
    assert sorted(map(tuple, rows)) == [("11", '"string"'), ("3", '{"type":\n "long"}')]


def test_documents_keep_their_path(spark, tmp_path):
    rows = registry.read_documents(spark, store(tmp_path, spark), "schema_id").collect()
    assert {r.subject for r in rows} == {f"{i}/schema.json" for i in (3, 11, 12)}


def test_strict_store_names_the_broken_document(spark, tmp_path):
    with pytest.raises(Exception, match="12/schema.json"):
        registry.read_schema_store(spark, store(tmp_path, spark), strict=True).collect()


def test_absent_store_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        registry.read_schema_store(spark, str(tmp_path)).collect()


@pytest.fixture
def parties(spark, tmp_path):
    for party, major, minor, schema_id in [
        ("a", "2.2", "1", 3),
        ("a", "2.2", "2", 11),
        ("a", "3.0", "0", 12),
        ("b", "2.2", "0", 5),
        ("c", "1.0", "0", 99),
        ("a", "2.2", "3", 11),
    ]:
        path = (
            f"schema_registry/counterparty={party}/major_version=v{major}"
            f"/minor_version={minor}/schema_id={schema_id}"
        )
        put(tmp_path, path, json.dumps({"id": schema_id, "minor": minor}, indent=1))
    return registry.read_registry(spark, str(tmp_path))


def test_registry_columns(parties):
    assert dict(parties.dtypes) == {
        "body": "string",
        "counterparty": "string",
        "major_version": "string",
        "minor_version": "string",
        "schema_id": "bigint",
    }
    assert parties.count() == 6
    assert parties.filter("schema_id = 5").first().body.count("\n") == 3


def test_latest_is_the_numeric_maximum_of_the_major_version(parties):
    rows = registry.latest_schema(parties).collect()
    found = {r.counterparty: (r.schema_id, json.loads(r.body)["minor"]) for r in rows}
    assert found == {"a": (11, "2"), "b": (5, "0")}
    assert registry.latest_schema(parties, counterparty="b").count() == 1
    assert registry.latest_schema(parties, "9.9").count() == 0


def test_version_filter_prunes_files(parties):
    plan = registry.latest_schema(parties)._jdf.queryExecution().executedPlan().toString()
    assert "major_version" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.fixture
def rows(spark):
    ids = [("7",), ("7",), ("8",), (None,)]
    return spark.createDataFrame(ids, "kafka_metadata_schemaid string")


@pytest.fixture
def schemas(spark):
    return spark.createDataFrame(
        [("7", "seven"), ("7", "other seven"), ("9", "nine"), ("1", None)],
        "schema_id string, body string",
    )


def test_ids_and_lookups(rows, schemas):
    assert {r.schema_id for r in registry.schema_ids(rows).collect()} == {"7", "8"}
    assert {r.schema_id for r in registry.schemas_for(rows, schemas).collect()} == {"7"}
    assert [r.schema_id for r in registry.missing_schemas(rows, schemas).collect()] == ["8"]


def test_an_ambiguous_id_does_not_multiply_rows(rows, schemas):
    joined = registry.attach_schema(rows, registry.unique_schemas(schemas)).collect()
    assert sorted((r.kafka_metadata_schemaid or "", r.schema_body) for r in joined) == [
        ("", None),
        ("7", "other seven"),
        ("7", "other seven"),
        ("8", None),
    ]


def test_schema_map_is_bounded(schemas):
    assert registry.schema_map(schemas) == {"7": "other seven", "9": "nine", "1": None}
    assert registry.schema_map(schemas, 10) is None
    assert registry.schema_map(schemas.limit(0)) == {}


def _schema_rows(spark, ids, word="body"):
    return spark.createDataFrame([(str(i), f"{word} {i}") for i in ids], "schema_id string, body string")


def test_a_schema_table_opens_only_what_the_ids_need(spark, tmp_path):
    table = registry.SchemaTable(spark, str(tmp_path / "t"), buckets=16)
    table.write(_schema_rows(spark, range(100)))
    ids = spark.createDataFrame([("7",), ("7",), (None,), ("999",), ("",)], "schema_id string")
    needed = table.needed(ids)
    assert "dynamicpruning" in needed._jdf.queryExecution().executedPlan().toString()
    kept = {p.parent for p in (tmp_path / "t").glob("bucket=*/*.parquet")}
    mine = {f"bucket={r[0]}" for r in ids.where("schema_id <> ''").select(table._bucket()).collect()}
    for folder in kept:
        if folder.name not in mine:
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"damaged")
            for crc in folder.glob(".*.crc"):
                crc.unlink()
    assert [tuple(r) for r in table.needed(ids).collect()] == [("7", "body 7")]
    with pytest.raises(Exception):
        table.all().collect()


def test_a_schema_table_grows_and_keeps_one_row_per_id(spark, tmp_path):
    table = registry.SchemaTable(spark, str(tmp_path / "t"), buckets=4)
    table.write(_schema_rows(spark, range(10)))
    table.write(_schema_rows(spark, [3, 11, 11], "a newer"))
    rows = dict(map(tuple, table.all().collect()))
    assert rows == {str(i): f"body {i}" for i in range(10)} | {"3": "a newer 3", "11": "a newer 11"}
    assert table.needed(_schema_rows(spark, [])).count() == 0
