"""Fitting rows to the columns of a catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def qualified(spark: SparkSession, table: str) -> str:
    """The table with its catalog in front, unless the name already has one."""
    if table.count(".") >= 2:
        return table
    database = "" if "." in table else f"{spark.catalog.currentDatabase()}."
    return f"{spark.catalog.currentCatalog()}.{database}{table}"


def table_columns(spark: SparkSession, table: str) -> StructType:
    """Columns of an existing table; an absent one is an error."""
    name = qualified(spark, table)
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table does not exist: {name}")
    return spark.table(name).schema


def align_to_table(
    df: DataFrame, schema: StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """One projection that casts every column of the table to its type.

    Adds ``processed = false``. A value that does not fit the type becomes
    null. ``columns`` picks and orders the result, the table's columns by
    default.
    """
    df = df.withColumn("processed", F.lit(False))
    missing = [field.name for field in schema.fields if field.name not in df.columns]
    if missing:
        raise ValueError(f"columns of the table that the rows lack: {missing}")
    aligned = df.withColumns(
        {field.name: F.col(field.name).try_cast(field.dataType) for field in schema.fields}
    )
    return aligned.select(*(columns or schema.names))
