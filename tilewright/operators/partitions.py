"""Row and partition counts per table, from the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Index ids of a table's own rows (heap or clustered), and the
# highest object id that belongs to the system.
BASE_INDEX_IDS = (0, 1)
LAST_SYSTEM_OBJECT = 255


def partition_info(tables: DataFrame, indexes: DataFrame, partitions: DataFrame) -> DataFrame:
    """Rows and partition count per table; a table with one partition counts as having 0."""
    base = indexes.where(
        F.col("index_id").isin(*BASE_INDEX_IDS) & (F.col("object_id") > LAST_SYSTEM_OBJECT)
    ).select("object_id", "index_id")
    count = F.count_distinct("partition_number")
    return (
        partitions.join(base, ["object_id", "index_id"])
        .join(tables.select("object_id"), "object_id", "left_semi")
        .groupBy("object_id")
        .agg(
            F.sum("rows").alias("rows"),
            F.when(count > 1, count).otherwise(0).cast("int").alias("PartitionCount"),
        )
    )
