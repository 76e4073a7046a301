"""Large-object columns: which ones exist, how large their values are, small/large split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tilewright.functions.columns import (
    byte_length,
    exact_kb,
    quoted,
    whole_average,
    whole_kb,
    whole_mb,
)
from tilewright.session import local_frame, union_all
from tilewright.sources.catalog import UNBOUNDED

# Type names that count as large objects when they are unbounded.
LOB_TYPES = ("text", "ntext", "image", "varbinary", "nvarchar", "varchar")
# Type names whose text takes two bytes per UTF-16 unit.
WIDE_TYPES = ("ntext", "nvarchar")

# The small-value count is a bigint so that tables beyond 2^31 rows fit.
LOB_PROFILE = (
    "object_id int, LOBColName string, CountLess1KAndNulls bigint, MaxLOBSizeKB decimal(18,7), "
    "AvgSizeKB int, MinSizeKB int, MaxSizeMB int, AvgSizeMB int, MinSizeMB int"
)


def lob_columns(
    columns: DataFrame, tables: DataFrame, schemas: DataFrame, types: DataFrame
) -> DataFrame:
    """Columns that need a LOB profile: a listed type without a length limit."""
    unbounded = columns.where(F.col("max_length") == UNBOUNDED).select(
        "object_id", "user_type_id", F.col("name").alias("column")
    )
    listed = types.where(F.col("name").isin(*LOB_TYPES)).select("user_type_id")
    return (
        unbounded.join(listed, "user_type_id")
        .join(tables.select("object_id", "schema_id", F.col("name").alias("table")), "object_id")
        .join(schemas.select("schema_id", F.col("name").alias("schema")), "schema_id")
        .select("object_id", "schema", "table", "column")
    )


def wide_columns(columns: DataFrame, types: DataFrame) -> DataFrame:
    """Columns whose text is stored as UTF-16, by type name."""
    wide = types.where(F.col("name").isin(*WIDE_TYPES)).select("user_type_id")
    return columns.join(wide, "user_type_id", "left_semi").select(
        "object_id", F.col("name").alias("column")
    )


def lob_profile(
    df: DataFrame,
    object_id: int,
    cols: Sequence[str],
    small_bytes: int = 1024,
    utf16: Iterable[str] = (),
) -> DataFrame:
    """Sizes of the LOB columns of one table, one row per listed column.

    A single scan and one partial/final aggregate serve all columns; a column
    listed twice yields two equal rows. Columns in ``utf16`` are sized as
    two-byte text.
    """
    utf16 = set(utf16)
    names = list(dict.fromkeys(cols))
    sizes = df.select(
        *[
            byte_length(F.col(quoted(c)), c in utf16).cast("bigint").alias(f"s{i}")
            for i, c in enumerate(names)
        ]
    )
    measures = []
    for i in range(len(names)):
        size = F.col(f"s{i}")
        small = F.when(size.isNull() | (size <= small_bytes), 1).otherwise(0)
        measures += [
            F.sum(small).alias(f"small{i}"),
            F.max(size).alias(f"max{i}"),
            whole_average(size).alias(f"avg{i}"),
            F.min(size).alias(f"min{i}"),
        ]
    position = {c: i for i, c in enumerate(names)}
    rows = [_profile_row(object_id, c, position[c]) for c in cols]
    return sizes.agg(*measures).select(F.inline(F.array(*rows)))


def lob_profiles(
    spark: SparkSession,
    lobs: Iterable[tuple[int, str, str, str]],
    tables: Mapping[str, DataFrame],
    small_bytes: int = 1024,
    utf16: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Profile of every LOB column of every table as one plan, one scan per table.

    ``lobs`` holds (object_id, schema, table, column) rows of ``lob_columns``;
    ``tables`` maps ``schema.table`` to its DataFrame.
    """
    utf16 = utf16 or {}
    by_table: dict[tuple[int, str], list[str]] = {}
    for object_id, schema, table, column in lobs:
        by_table.setdefault((object_id, f"{schema}.{table}"), []).append(column)
    parts = [
        lob_profile(tables[name], object_id, cols, small_bytes, utf16.get(name, ()))
        for (object_id, name), cols in sorted(by_table.items())
    ]
    if not parts:
        return local_frame(spark, [], LOB_PROFILE)
    return union_all(parts)


def dedup_profile(profile: DataFrame) -> DataFrame:
    """One profile row per (object_id, LOBColName); of several, the largest values win."""
    order = [F.desc_nulls_last(c) for c in profile.columns if c not in ("object_id", "LOBColName")]
    ranked = profile.withColumn(
        "rank", F.row_number().over(W.partitionBy("object_id", "LOBColName").orderBy(*order))
    )
    return ranked.where("rank = 1").drop("rank")


def lob_split(
    df: DataFrame, col: str, small_bytes: int = 1024, utf16: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows with a small (or null) value and rows with a large one, each as a plain filter."""
    large = byte_length(F.col(quoted(col)), utf16) > small_bytes
    return df.where(F.coalesce(~large, F.lit(True))), df.where(large)


def _profile_row(object_id: int, name: str, i: int) -> Column:
    largest, average, smallest = (F.col(f"{m}{i}") for m in ("max", "avg", "min"))
    return F.struct(
        F.lit(object_id).alias("object_id"),
        F.lit(name).alias("LOBColName"),
        F.col(f"small{i}").alias("CountLess1KAndNulls"),
        exact_kb(largest).alias("MaxLOBSizeKB"),
        whole_kb(average).alias("AvgSizeKB"),
        whole_kb(smallest).alias("MinSizeKB"),
        whole_mb(largest).alias("MaxSizeMB"),
        whole_mb(average).alias("AvgSizeMB"),
        whole_mb(smallest).alias("MinSizeMB"),
    )
