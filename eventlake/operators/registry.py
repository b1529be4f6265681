"""Schema documents as DataFrames: scans, lookups and the newest version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.scratch import file_exists, new_folder, remove

# Largest schema store, in bytes of document text, that is shipped to every
# executor. Beyond it schemas are joined to the rows.
MAX_SCHEMA_BYTES = 32 * 1024 * 1024

# File name pattern of the documents in a store.
DOCUMENTS = "schema.json"

REGISTRY_DDL = (
    "body string, counterparty string, major_version string, "
    "minor_version string, schema_id long"
)


def read_documents(
    spark: SparkSession, root: str, prefix: str, documents: str = DOCUMENTS
) -> DataFrame:
    """Every schema document under ``root/prefix`` as (``subject``, ``body``).

    ``subject`` is the path below the prefix.
    """
    files = spark.read.option("recursiveFileLookup", True).option(
        "pathGlobFilter", documents
    )
    path = F.col("_metadata.file_path")
    return files.text(f"{root}/{prefix}", wholetext=True).select(
        F.regexp_extract(path, f"^.*/{prefix}/(.*)$", 1).alias("subject"),
        F.col("value").alias("body"),
    )


def read_schema_store(spark: SparkSession, root: str, strict: bool = False) -> DataFrame:
    """``schema_id/<id>/schema.json`` as (``schema_id``, ``body``).

    A document that is not JSON counts as absent, or fails the read if ``strict``.
    """
    documents = read_documents(spark, root, "schema_id")
    is_json = F.try_parse_json("body").isNotNull()
    if strict:
        message = F.concat(F.lit("schema document is not JSON: "), F.col("subject"))
        documents = documents.withColumn(
            "body", F.when(is_json, F.col("body")).otherwise(F.raise_error(message))
        )
    else:
        documents = documents.filter(is_json)
    return documents.select(F.substring_index("subject", "/", 1).alias("schema_id"), "body")


# Distinct ids that are few enough to be broadcast.
MAX_BROADCAST_IDS = 500_000


class SchemaTable:
    """Schemas by id as a table whose directories are parts of the ids.

    A reader with some ids opens only the directories that these fall in, which Spark
    finds out while it runs (dynamic partition pruning); nothing is listed per id.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("schema_id"), F.lit(self.buckets)).cast("int")

    def write(self, schemas: DataFrame) -> None:
        """Replaces the directories of these schemas' ids with what they hold and these; one row per id.

        Of documents of one id the smallest stays, also beside one that the table has.
        """
        new = schemas.select("schema_id", "body").where("schema_id is not null")
        if file_exists(self.spark, self.path):
            touched = self.all().withColumn("bucket", self._bucket())
            touched = touched.join(new.select(self._bucket().alias("bucket")).distinct(), "bucket", "left_semi")
            new = new.unionByName(touched.select("schema_id", "body"))
        folder = new_folder(self.spark, "schema-rows")
        _one_per_id(new).withColumn("bucket", self._bucket()).write.parquet(folder)
        rows = self.spark.read.parquet(folder).repartition("bucket")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
        remove(self.spark, folder)

    def _read(self) -> DataFrame:
        return self.spark.read.schema("schema_id string, body string, bucket int").parquet(self.path)

    def all(self) -> DataFrame:
        return self._read().select("schema_id", "body")

    def needed(self, ids: DataFrame) -> DataFrame:
        """The schemas of the ids in column ``schema_id``; null and absent ids have none."""
        # Written first: their number is then known, and their source is read once.
        folder = new_folder(self.spark, "ids")
        ids.select("schema_id").where("schema_id <> ''").distinct().write.parquet(folder)
        ids = self.spark.read.schema("schema_id string").parquet(folder)
        few = ids.count() <= MAX_BROADCAST_IDS
        # The comparison tells the optimizer that this side is worth pruning by.
        ids = ids.where("schema_id <> ''").withColumn("bucket", self._bucket())
        found = self._read().join(F.broadcast(ids) if few else ids, ["bucket", "schema_id"], "left_semi")
        return found.select("schema_id", "body")


def read_registry(
    spark: SparkSession, root: str, documents: str = DOCUMENTS
) -> DataFrame:
    """``schema_registry/counterparty=…/major_version=v…/minor_version=…/schema_id=…``.

    The path keys become columns by partition discovery, so filters on them
    prune files. Their types are declared: ids compare as numbers, versions
    stay text.
    """
    return (
        spark.read.schema(REGISTRY_DDL)
        .option("pathGlobFilter", documents)
        .text(f"{root}/schema_registry", wholetext=True)
    )


def latest_schema(
    registry: DataFrame, major: str = "2.2", counterparty: str | None = None
) -> DataFrame:
    """Newest schema of one major version, one row per counterparty.

    Newest is the numerically largest id. Should one id appear under several
    minor versions, the first of them in text order is taken.
    """
    chosen = registry.filter(F.col("major_version") == f"v{major}")
    if counterparty is not None:
        chosen = chosen.filter(F.col("counterparty") == counterparty)
    newest_first = F.struct(-F.col("schema_id"), F.col("minor_version"))
    return chosen.groupBy("counterparty").agg(
        F.max("schema_id").alias("schema_id"), F.min_by("body", newest_first).alias("body")
    )


def schema_ids(df: DataFrame) -> DataFrame:
    """Schema ids that occur in the rows; deduplicated before the shuffle."""
    return (
        df.select(F.col("kafka_metadata_schemaid").alias("schema_id"))
        .filter(F.col("schema_id").isNotNull())
        .distinct()
    )


def schemas_for(df: DataFrame, schemas: DataFrame) -> DataFrame:
    """Schemas whose id occurs in the rows."""
    return schemas.join(schema_ids(df), "schema_id", "left_semi")


def missing_schemas(df: DataFrame, schemas: DataFrame) -> DataFrame:
    """Schema ids that occur in the rows and are not in the store."""
    return schema_ids(df).join(schemas.select("schema_id"), "schema_id", "left_anti")


def attach_schema(df: DataFrame, schemas: DataFrame) -> DataFrame:
    """Left join of the rows with their schema document as ``schema_body``.

    ``schemas`` has one row per id, see :func:`unique_schemas`. No broadcast is
    forced: the planner broadcasts a store it knows to be below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
    adaptive execution splits an id that holds a large share of the rows.
    """
    bodies = schemas.select(
        F.col("schema_id").alias("kafka_metadata_schemaid"), F.col("body").alias("schema_body")
    )
    return df.join(bodies, "kafka_metadata_schemaid", "left")


def _one_per_id(schemas: DataFrame) -> DataFrame:
    return schemas.groupBy("schema_id").agg(F.min("body").alias("body"))


def unique_schemas(schemas: DataFrame) -> DataFrame:
    """One row per id, written to the shared scratch folder and read back.

    Read from a table the schemas are shuffled right below the join. An
    aggregate in between would keep adaptive execution from splitting a hot id.
    """
    spark = schemas.sparkSession
    folder = new_folder(spark, "schemas")
    _one_per_id(schemas).write.parquet(folder)
    return spark.read.parquet(folder)


def schema_map(schemas: DataFrame, max_bytes: int = MAX_SCHEMA_BYTES) -> dict[str, str] | None:
    """The store as id -> document, or None when it is larger than ``max_bytes``.

    The size is aggregated on the executors first, so nothing unbounded reaches
    the driver. The store is read once for both steps.
    """
    unique = _one_per_id(schemas).persist()
    try:
        text = F.octet_length("schema_id") + F.coalesce(F.octet_length("body"), F.lit(0))
        if (unique.agg(F.sum(text)).first()[0] or 0) > max_bytes:
            return None
        return {row.schema_id: row.body for row in unique.collect()}
    finally:
        unique.unpersist()
