"""Primary keys, from the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tilewright.sources.catalog import Catalog


def leading_key_column(catalog: Catalog) -> DataFrame:
    """First column of each table's primary key; null for a table without one."""
    primary = catalog.indexes.where(F.col("is_primary_key") == 1).select("object_id", "index_id")
    first = (
        catalog.index_columns.where(F.col("index_column_id") == 1)
        .join(catalog.columns, ["object_id", "column_id"])
        .select("object_id", "index_id", F.col("name").alias("first_column"))
    )
    return (
        catalog.tables.select("object_id", "schema_id", F.col("name").alias("TableName"))
        .join(catalog.schemas.select("schema_id", F.col("name").alias("SchemaName")), "schema_id")
        .join(primary, "object_id", "left")
        .join(first, ["object_id", "index_id"], "left")
        .select("SchemaName", "TableName", "first_column")
    )
