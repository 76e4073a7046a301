"""Checks after a load: sequence positions and column statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tilewright.functions.columns import quoted
from tilewright.session import union_all


def sequence_positions(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Next value of the sequence behind each key: one past the largest key, 1 when empty.

    ``tables`` maps a name to (DataFrame, key column); only the key is read.
    """
    parts = [
        df.agg(F.max(quoted(key)).cast("bigint").alias("last_value")).select(
            F.lit(name).alias("table_name"),
            F.lit(key).alias("key_column"),
            "last_value",
            (F.coalesce("last_value", F.lit(0)) + 1).alias("next_value"),
        )
        for name, (df, key) in tables.items()
    ]
    return union_all(parts)


# Size of a distinct-count sketch: 2^14 registers, a relative error of about 1 %.
SKETCH_LOG_SIZE = 14


# Whole numbers and dates that span no more than this are counted in bitmaps, in which a
# task holds 8 MB of one column at most.
BITMAP_SPAN = 1 << 26
BITMAP_TYPES = (T.IntegralType, T.DateType, T.BooleanType)


def column_stats(df: DataFrame, name: str, exact_distinct: bool = False) -> DataFrame:
    """Rows, nulls, smallest, largest and distinct values of every column, from one scan.

    The distinct count is a sketch unless ``exact_distinct`` is set; see ``distinct_counts``
    for what the exact one costs. Nested columns have no smallest and largest value, and
    maps no distinct count.
    """
    measures = [F.count(F.lit(1)).alias("n")]
    nothing = F.lit(None)
    for i, f in enumerate(df.schema.fields):
        col = F.col(quoted(f.name))
        sketched = not exact_distinct and _countable(f.dataType)
        plain = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        measures += [
            F.count(col).alias(f"present{i}"),
            (F.min(col).cast("string") if plain else nothing.cast("string")).alias(f"min{i}"),
            (F.max(col).cast("string") if plain else nothing.cast("string")).alias(f"max{i}"),
            (_sketched_count(col) if sketched else nothing.cast("bigint")).alias(f"distinct{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.col("n").alias("row_count"),
            (F.col("n") - F.col(f"present{i}")).alias("null_count"),
            F.col(f"distinct{i}").alias("distinct_count"),
            F.col(f"min{i}").alias("min_value"),
            F.col(f"max{i}").alias("max_value"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    stats = df.agg(*measures).select(F.inline(F.array(*rows)))
    countable = [f.name for f in df.schema.fields if exact_distinct and _countable(f.dataType)]
    if not countable:
        return stats
    exact = distinct_counts(df, countable)
    return stats.join(exact.withColumnRenamed("distinct_count", "exact"), "column_name", "left").select(
        *[F.col("exact").alias(c) if c == "distinct_count" else F.col(c) for c in stats.columns]
    )


def _countable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.MapType, T.VariantType))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, bitmap_span: int = BITMAP_SPAN) -> DataFrame:
    """Exact number of distinct values of each column: column_name, distinct_count.

    Whole numbers, dates and booleans of a short span (told by one scan of their least and
    greatest values) are set as bits of bitmaps, which tasks combine by ``or``: their values
    are never shuffled, and what is shuffled depends on the span alone. Of the others the
    distinct values are shuffled, fixed-size ones as they are and the rest as SHA-256. Every
    column is read by a scan of its own, so a columnar source is read once in all.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    parts = []
    spans = _spans(df, [f for f in fields if isinstance(f.dataType, BITMAP_TYPES)])
    for f in fields:
        col = F.col(quoted(f.name))
        least, greatest = spans.get(f.name, (None, None))
        if least is not None and greatest - least < bitmap_span:
            # Bits are numbered from the least value on, so that negative ones need no care.
            bit = _whole(col, f.dataType) - F.lit(least).cast("bigint")
            counted = (
                df.select(bit.alias("bit"))
                .where("bit IS NOT NULL")
                .groupBy(F.shiftright("bit", 15).alias("bucket"))
                .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(0x7FFF))).alias("map"))
                .agg(F.coalesce(F.sum(F.bitmap_count("map")), F.lit(0)).alias("distinct_count"))
            )
        else:
            counted = (
                df.select(_identity(col, f.dataType).alias("value"))
                .where("value IS NOT NULL")
                .distinct()
                .agg(F.count(F.lit(1)).alias("distinct_count"))
            )
        parts.append(counted.select(F.lit(f.name).alias("column_name"), F.col("distinct_count").cast("bigint")))
    return union_all(parts)


def _spans(df: DataFrame, fields: Sequence[T.StructField]) -> dict[str, tuple[int | None, int | None]]:
    """Least and greatest value of each column as whole numbers; nulls where there is none."""
    if not fields:
        return {}
    ends = []
    for i, f in enumerate(fields):
        number = _whole(F.col(quoted(f.name)), f.dataType)
        ends += [F.min(number).alias(f"min{i}"), F.max(number).alias(f"max{i}")]
    row = df.agg(*ends).first()
    return {f.name: (row[f"min{i}"], row[f"max{i}"]) for i, f in enumerate(fields)}


def _whole(col: Column, dtype: T.DataType) -> Column:
    return (F.unix_date(col) if isinstance(dtype, T.DateType) else col).cast("bigint")


def _identity(col: Column, dtype: T.DataType) -> Column:
    """A short value that is the same for equal values only."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col + F.lit(0.0)  # both zeros are one value
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.unhex(F.sha2(col.cast("binary"), 256))
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        options = {"ignoreNullFields": "false"}
        return F.when(col.isNotNull(), F.unhex(F.sha2(F.to_json(F.struct(col.alias("v")), options), 256)))
    return col


def _sketched_count(col: Column) -> Column:
    hashed = F.when(col.isNotNull(), F.xxhash64(col))
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(hashed, SKETCH_LOG_SIZE)), F.lit(0))
