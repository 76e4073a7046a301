"""The seven catalog frames, and how to get them from Spark tables.

A catalog says which tables, columns, indexes and partitions exist. The planner
only ever reads it through these frames, whatever system they describe.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from tilewright.functions.columns import quoted
from tilewright.session import CONCURRENT_PLANS, local_frame, union_all

COLUMNS = "object_id int, column_id int, name string, user_type_id int, max_length int"
TABLES = "object_id int, schema_id int, name string, is_ms_shipped int"
SCHEMAS = "schema_id int, name string"
TYPES = "user_type_id int, name string"
INDEXES = "object_id int, index_id int, is_primary_key int"
PARTITIONS = "object_id int, index_id int, partition_number int, rows bigint"
INDEX_COLUMNS = "object_id int, index_id int, index_column_id int, column_id int"

# Type ids of the catalog. Only the names matter to the planner.
TYPE_IDS = {
    "image": 34,
    "text": 35,
    "date": 40,
    "datetime2": 42,
    "tinyint": 48,
    "smallint": 52,
    "int": 56,
    "real": 59,
    "float": 62,
    "ntext": 99,
    "bit": 104,
    "decimal": 106,
    "bigint": 127,
    "varbinary": 165,
    "varchar": 167,
    "nvarchar": 231,
    "json": 244,
}

UNBOUNDED = -1


@dataclass(frozen=True)
class Catalog:
    columns: DataFrame
    tables: DataFrame
    schemas: DataFrame
    types: DataFrame
    indexes: DataFrame
    partitions: DataFrame
    index_columns: DataFrame

    def union(self, other: Catalog) -> Catalog:
        """Rows of both catalogs. Object and schema ids must not clash."""
        return Catalog(
            **{
                f.name: getattr(self, f.name).unionByName(getattr(other, f.name))
                for f in fields(self)
            }
        )


@dataclass(frozen=True)
class TableSpec:
    """What a bare DataFrame does not say about itself.

    ``lengths`` maps a string or binary column to its declared length, with
    ``UNBOUNDED`` for no limit; one left out has no limit either. ``type_names``
    replaces the type name derived from the Spark type.
    """

    key: Sequence[str] = ()
    partition_by: Column | None = None
    lengths: Mapping[str, int] = field(default_factory=dict)
    type_names: Mapping[str, str] = field(default_factory=dict)


def build_catalog(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec] | None = None,
    schema: str = "main",
    schema_id: int = 1,
    first_object_id: int = 1001,
    check_keys: bool = False,
    known_rows: Mapping[str, tuple[int, int]] | None = None,
) -> Catalog:
    """Describe ``frames`` (table name to DataFrame), object ids in name order.

    The rows of all tables and partitions are counted by one aggregate over all of them,
    which reads partition expressions only: for Parquet, file footers and directory names.
    Tables in ``known_rows`` (rows, partitions) are not counted at all. Columns are
    described by what is declared; no values are read. Spark does not enforce keys;
    with ``check_keys`` a key that holds nulls is not marked as primary, at the
    price of a scan of the key columns.
    """
    specs, known_rows = specs or {}, known_rows or {}
    ids = {name: first_object_id + i for i, name in enumerate(sorted(frames))}
    columns, tables, indexes, index_columns = [], [], [], []
    checked, counted, known = [], [], []
    for name, object_id in ids.items():
        df, spec = frames[name], specs.get(name, TableSpec())
        index_id = 1 if spec.key else 0  # clustered on the key, or a heap
        tables.append((object_id, schema_id, name, 0))
        if spec.key and check_keys:
            checked.append(_checked_index(df, object_id, index_id, spec.key))
        else:
            indexes.append((object_id, index_id, index_id))
        if name in known_rows:
            known += _known_partitions(object_id, index_id, *known_rows[name])
        else:
            counted.append((df, object_id, index_id, spec.partition_by))
        positions = {c: i for i, c in enumerate(df.columns, start=1)}
        for i, key in enumerate(spec.key, start=1):
            index_columns.append((object_id, index_id, i, positions[key]))
        for f in df.schema.fields:
            type_id = TYPE_IDS[spec.type_names.get(f.name, _type_name(f.dataType))]
            length = _length(f.dataType, spec.lengths.get(f.name))
            columns.append((object_id, positions[f.name], f.name, type_id, length))
    return Catalog(
        columns=local_frame(spark, columns, COLUMNS),
        tables=local_frame(spark, tables, TABLES),
        schemas=local_frame(spark, [(schema_id, schema)], SCHEMAS),
        types=local_frame(spark, [(i, n) for n, i in TYPE_IDS.items()], TYPES),
        indexes=union_all([local_frame(spark, indexes, INDEXES), *checked]),
        partitions=_partition_rows(spark, counted, known),
        index_columns=local_frame(spark, index_columns, INDEX_COLUMNS),
    )


def session_catalog(
    spark: SparkSession,
    database: str,
    keys: Mapping[str, Sequence[str]] | None = None,
    statistics: bool = False,
) -> tuple[Catalog, dict[str, DataFrame]]:
    """Catalog and tables of one database in the session catalog.

    Declared ``varchar(n)`` lengths and partition columns are taken from the
    table definition; ``keys`` names primary keys, which Spark does not hold. With
    ``statistics`` the rows of tables that have been analysed are those that the session
    catalog holds, as old as these are, and their partitions those it lists; no file is looked
    at. Of a partitioned table all rows then stand at its first partition.
    """
    keys = keys or {}
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]

    def describe(name: str) -> tuple[DataFrame, TableSpec, tuple[int, int] | None]:
        full_name = f"{quoted(database)}.{quoted(name)}"
        df = spark.table(full_name)
        declared, parted, rows = _read_description(spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").collect())
        spec = TableSpec(
            key=tuple(keys.get(name, ())),
            partition_by=F.struct(*map(quoted, parted)) if parted else None,
            lengths={
                f.name: _declared_length(declared.get(f.name, ""))
                for f in df.schema.fields
                if isinstance(f.dataType, (T.StringType, T.BinaryType))
            },
        )
        known = None
        if statistics and rows is not None:
            known = rows, spark.sql(f"SHOW PARTITIONS {full_name}").count() if parted else 0
        return df, spec, known

    with ThreadPoolExecutor(CONCURRENT_PLANS) as pool:  # each asks the catalog, none runs a job
        found = dict(zip(names, pool.map(describe, names)))
    frames = {name: df for name, (df, _, _) in found.items()}
    catalog = build_catalog(
        spark,
        frames,
        {name: spec for name, (_, spec, _) in found.items()},
        schema=database,
        known_rows={name: known for name, (_, _, known) in found.items() if known},
    )
    return catalog, {f"{database}.{name}": df for name, df in frames.items()}


def _read_description(rows: Sequence[T.Row]) -> tuple[dict[str, str], list[str], int | None]:
    """Declared types, partition columns and analysed rows out of ``DESCRIBE TABLE EXTENDED``."""
    declared: dict[str, str] = {}
    parted: list[str] = []
    rows_held, part = None, "columns"
    for name, kind in ((r["col_name"], r["data_type"]) for r in rows):
        if name.startswith("# Partition"):
            part = "partitions"
        elif name.startswith("# Detailed"):
            part = "details"
        elif part == "columns" and name and not name.startswith("#"):
            declared[name] = kind
        elif part == "partitions" and name and not name.startswith("#"):
            parted.append(name)
        elif part == "details" and name == "Statistics":
            held = re.search(r"(\d+) rows", kind)
            rows_held = int(held.group(1)) if held else None
    return declared, parted, rows_held


def session_databases(spark: SparkSession) -> DataFrame:
    """Names of the session catalog's databases, as the schema list operators expect them."""
    names = [(d.name,) for d in spark.catalog.listDatabases()]
    return local_frame(spark, names, "schema_name string")


def _checked_index(
    df: DataFrame, object_id: int, index_id: int, key: Sequence[str]
) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [F.col(quoted(k)).isNotNull() for k in key])
    return df.agg(F.min(complete).alias("complete")).select(
        F.lit(object_id).alias("object_id"),
        F.lit(index_id).alias("index_id"),
        F.coalesce(F.col("complete").cast("int"), F.lit(1)).alias("is_primary_key"),
    )


def _known_partitions(object_id: int, index_id: int, rows: int, partitions: int) -> list[tuple]:
    return [(object_id, index_id, i, 0 if i > 1 else rows) for i in range(1, max(partitions, 1) + 1)]


def _partition_rows(
    spark: SparkSession, counted: Sequence[tuple[DataFrame, int, int, Column | None]], known: list[tuple]
) -> DataFrame:
    """Rows of every partition, of all tables in one aggregate; a whole table has a row even if it is empty.

    Partitions are told apart by their values as text, which all tables can share a column of.
    """
    held = local_frame(spark, known, PARTITIONS)
    if not counted:
        return held
    schema = "object_id int, index_id int, parted boolean, part string, n bigint"
    parts = [
        df.select(
            F.lit(object_id).alias("object_id"),
            F.lit(index_id).alias("index_id"),
            F.lit(by is not None).alias("parted"),
            (F.lit(None).cast("string") if by is None else _as_text(df, by)).alias("part"),
            F.lit(1).cast("bigint").alias("n"),
        )
        for df, object_id, index_id, by in counted
    ]
    empty = [(object_id, index_id, False, None, 0) for _, object_id, index_id, by in counted if by is None]
    # Numbers only tell partitions apart, so no order over all of them is needed.
    number = F.when(F.col("parted"), F.monotonically_increasing_id() + 1).otherwise(1)
    return (
        union_all([*parts, local_frame(spark, empty, schema)])
        .groupBy("object_id", "index_id", "parted", "part")
        .agg(F.sum("n").alias("rows"))
        .select("object_id", "index_id", number.alias("partition_number"), "rows")
        .unionByName(held)
    )


def _as_text(df: DataFrame, by: Column) -> Column:
    dtype = df.select(by.alias("p")).schema["p"].dataType
    if isinstance(dtype, T.BinaryType):
        return F.hex(by)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(by.isNotNull(), F.to_json(F.struct(by.alias("p")), {"ignoreNullFields": "false"}))
    return by.cast("string")


def _type_name(dtype: T.DataType) -> str:
    for spark_type, name in (
        (T.StringType, "varchar"),
        (T.BinaryType, "varbinary"),
        (T.ByteType, "tinyint"),
        (T.ShortType, "smallint"),
        (T.IntegerType, "int"),
        (T.LongType, "bigint"),
        (T.FloatType, "real"),
        (T.DoubleType, "float"),
        (T.BooleanType, "bit"),
        (T.DecimalType, "decimal"),
        (T.DateType, "date"),
        (T.TimestampType, "datetime2"),
        (T.TimestampNTZType, "datetime2"),
    ):
        if isinstance(dtype, spark_type):
            return name
    return "json"


def _length(dtype: T.DataType, declared: int | None) -> int:
    if declared is not None:
        return declared
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return UNBOUNDED
    widths = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.BooleanType: 1, T.DateType: 3}
    return widths.get(type(dtype), 8)


def _declared_length(data_type: str) -> int:
    kind, _, rest = data_type.partition("(")
    return int(rest.rstrip(")")) if kind in ("varchar", "char") and rest else UNBOUNDED
