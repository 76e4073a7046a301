"""The table report: one row per table and LOB column, or per table without LOBs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tilewright.functions.columns import size_class
from tilewright.operators.partitions import partition_info
from tilewright.sources.catalog import Catalog

REPORT = (
    "ID int, TableName string, SchemaName string, rows bigint, IsPartitioned string, "
    "PartitionCount int, ContainsLOBs string, ConcatenatedLOBs string, CountLess1KAndNulls bigint, "
    "MaxLOBSizeKB decimal(18,7), AvgSizeKB int, MinSizeKB int, MaxSizeMB int, AvgSizeMB int, "
    "MinSizeMB int, TableSize string, Type string, Table_JSON string"
)

_SIZES = ["AvgSizeKB", "MinSizeKB", "MaxSizeMB", "AvgSizeMB", "MinSizeMB"]


def table_report(
    catalog: Catalog,
    profile: DataFrame,
    size_bounds: Sequence[int] = (10_000, 50_000, 100_000),
) -> DataFrame:
    """Rows, partitions, LOB sizes, size class and an id for each user table.

    ``profile`` holds one row per LOB column. Everything joined here is as
    small as the catalog, so the single ordering for the id is too.
    """
    lobs = (
        profile.groupBy("object_id", F.col("LOBColName").alias("ConcatenatedLOBs"), *_SIZES)
        .agg(
            F.sum("CountLess1KAndNulls").alias("CountLess1KAndNulls"),
            F.max("MaxLOBSizeKB").alias("MaxLOBSizeKB"),
        )
        .withColumn("has_lob", F.lit(True))
    )
    user_tables = catalog.tables.where(
        ~F.col("name").ilike("dt%") & (F.col("is_ms_shipped") == 0)
    ).select("object_id", "schema_id", F.col("name").alias("TableName"))
    rows = (
        user_tables.join(
            catalog.schemas.select("schema_id", F.col("name").alias("SchemaName")), "schema_id"
        )
        .join(partition_info(catalog.tables, catalog.indexes, catalog.partitions), "object_id")
        .join(lobs, "object_id", "left")
        .select(
            "TableName",
            "SchemaName",
            "rows",
            F.when(F.col("PartitionCount") > 0, "Partitioned")
            .otherwise("Not Partitioned")
            .alias("IsPartitioned"),
            "PartitionCount",
            F.when(F.col("has_lob"), "Yes").otherwise("No").alias("ContainsLOBs"),
            F.coalesce("ConcatenatedLOBs", F.lit("")).alias("ConcatenatedLOBs"),
            *[
                F.coalesce(c, F.lit(0)).cast(dtype).alias(c)
                for c, dtype in [
                    ("CountLess1KAndNulls", "bigint"),
                    ("MaxLOBSizeKB", "decimal(18,7)"),
                    *[(c, "int") for c in _SIZES],
                ]
            ],
            size_class(F.col("rows"), size_bounds).alias("TableSize"),
            F.lit(None).cast("string").alias("Type"),
            F.lit("").alias("Table_JSON"),
        )
        .distinct()
    )
    order = W.orderBy(F.desc("MaxLOBSizeKB"), "SchemaName", "TableName", "ConcatenatedLOBs", *_SIZES)
    return rows.select(F.row_number().over(order).alias("ID"), *rows.columns)


def rollup_by_table(report: DataFrame) -> DataFrame:
    """Report rows folded to one per table, with the largest value of each measure."""
    return report.groupBy("SchemaName", "TableName").agg(
        *[
            F.max(c).alias(c)
            for c in ("PartitionCount", "rows", "ContainsLOBs", "MaxLOBSizeKB")
        ]
    )


def final_report(report: DataFrame, report_name: str = "load_report") -> DataFrame:
    """The report without the table it is stored in, largest tables first."""
    return report.where(F.col("TableName") != report_name).orderBy(F.desc("rows"), "ID")
