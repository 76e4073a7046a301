"""Catalogs and tables of a database server through Spark's JDBC source.

The driver class has to be on Spark's class path. Nothing here opens a
connection before an action runs, and credentials are only handed to Spark.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tilewright.operators.names import user_databases, user_pg_databases, user_schemas
from tilewright.sources.catalog import Catalog

# JDBC driver classes, URL forms, default databases, database lists and SQL forms.
SQL_SERVER = {
    "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "url": "jdbc:sqlserver://{host}:{port};databaseName={database};encrypt=true",
    "port": 1433,
    "database": "master",
    "databases": "SELECT name, state_desc FROM sys.databases",
    "quotes": "[]",
    "text": "N'{}'",
    "text_order": "Latin1_General_100_BIN2",
    "time": "CAST('{}' AS datetime2(6))",
    "instant": "CAST('{} +00:00' AS datetimeoffset(6))",
    "binary": "0x{}",
    "booleans": ("0", "1"),
}
POSTGRES = {
    "driver": "org.postgresql.Driver",
    "url": "jdbc:postgresql://{host}:{port}/{database}",
    "port": 5432,
    "database": "postgres",
    "databases": "SELECT datname, datistemplate, datallowconn FROM pg_database",
    "quotes": '""',
    "text": "'{}'",
    "text_order": '"C"',
    "time": "CAST('{}' AS timestamp)",
    "instant": "CAST('{}+00' AS timestamptz)",
    "binary": "decode('{}', 'hex')",
    "booleans": ("false", "true"),
}
SCHEMA_LIST = "SELECT schema_name FROM information_schema.schemata"

# Only the columns the planner reads; the server casts them to the frames' types.
_CATALOG_QUERIES = {
    "columns": "SELECT object_id, column_id, name, user_type_id, CAST(max_length AS int) AS max_length FROM sys.columns",
    "tables": "SELECT object_id, schema_id, name, CAST(is_ms_shipped AS int) AS is_ms_shipped FROM sys.tables",
    "schemas": "SELECT schema_id, name FROM sys.schemas",
    "types": "SELECT user_type_id, name FROM sys.types",
    "indexes": "SELECT object_id, index_id, CAST(is_primary_key AS int) AS is_primary_key FROM sys.indexes",
    "partitions": "SELECT object_id, index_id, partition_number, rows FROM sys.partitions",
    "index_columns": "SELECT object_id, index_id, index_column_id, column_id FROM sys.index_columns",
}


@dataclass(frozen=True)
class JdbcServer:
    kind: dict
    host: str
    user: str
    password: str = field(repr=False)
    database: str | None = None
    port: int | None = None

    def options(self) -> dict[str, str]:
        return {
            "url": self.kind["url"].format(
                host=self.host,
                port=self.port or self.kind["port"],
                database=self.database or self.kind["database"],
            ),
            "driver": self.kind["driver"],
            "user": self.user,
            "password": self.password,
            # Times without a zone stay so; what is read as an instant is one on the server too.
            "preferTimestampNTZ": "true",
        }


def read_query(spark: SparkSession, server: JdbcServer, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**server.options()).option("query", query).load()


def read_databases(spark: SparkSession, server: JdbcServer) -> DataFrame:
    """Names of the server's user databases; the filter runs on the server."""
    databases = read_query(spark, server, server.kind["databases"])
    return user_databases(databases) if server.kind is SQL_SERVER else user_pg_databases(databases)


def read_schemas(spark: SparkSession, server: JdbcServer) -> DataFrame:
    """Names of the user schemas of the database the server entry points to."""
    return user_schemas(read_query(spark, server, SCHEMA_LIST))


def read_catalog(spark: SparkSession, server: JdbcServer) -> Catalog:
    return Catalog(**{k: read_query(spark, server, q) for k, q in _CATALOG_QUERIES.items()})


def read_table(
    spark: SparkSession,
    server: JdbcServer,
    table: str,
    key: str | None = None,
    boundaries: DataFrame | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table as a DataFrame, read in one slice per key range when boundaries are given.

    ``boundaries`` is what ``range_boundaries`` returns for the key.
    """
    reader_options = {**server.options(), "fetchsize": str(fetch_size)}
    predicates = range_predicates(server.kind, key, boundaries) if key and boundaries is not None else []
    if len(predicates) < 2:
        return spark.read.format("jdbc").options(**reader_options).option("dbtable", table).load()
    url = reader_options.pop("url")
    return spark.read.jdbc(url, table, predicates=predicates, properties=reader_options)


def read_tables(
    spark: SparkSession,
    server: JdbcServer,
    names: Iterable[str],
    ranges: Mapping[str, tuple[str, DataFrame]] | None = None,
) -> dict[str, DataFrame]:
    """Tables by name; those in ``ranges`` (key and boundaries) are read in slices."""
    ranges = ranges or {}
    return {name: read_table(spark, server, name, *ranges.get(name, ())) for name in names}


def range_predicates(kind: dict, key: str, boundaries: DataFrame) -> list[str]:
    """One server predicate per key range; together they hold every row once.

    Ranges are half open, the first one also takes null keys, and equal boundaries (of a
    hot key) give no empty range. Text is compared in the order of its code points, as
    Spark does, whatever the column's collation. Instants are written in UTC with their
    offset, so that no session zone and no change of daylight saving time touches them;
    times without a zone are written as they are. Boundaries that are not in ascending order
    are an error.
    """
    dtype = boundaries.schema["min_val"].dataType
    literal = _literal_maker(kind, dtype)
    starts = boundaries.where("loc > 1 AND min_val IS NOT NULL").agg(
        F.array_sort(F.collect_list(F.struct("loc", "min_val")))["min_val"].alias("keys")
    )
    row = starts.select(
        F.transform("keys", lambda k: _as_text(k, dtype)).alias("keys"),
        (F.col("keys") == F.array_sort("keys")).alias("ascending"),
    ).first()
    if not row.ascending:
        raise ValueError(f"boundaries of {key} are not in ascending order")
    values = list(dict.fromkeys(map(literal, row["keys"])))
    name = _quoted_name(kind, key)
    column = f"{name} COLLATE {kind['text_order']}" if isinstance(dtype, T.StringType) else name
    if not values:
        return ["1 = 1"]
    first = [f"({column} < {values[0]} OR {name} IS NULL)"]
    middle = [f"({column} >= {lo} AND {column} < {hi})" for lo, hi in zip(values, values[1:])]
    return first + middle + [f"({column} >= {values[-1]})"]


def _quoted_name(kind: dict, name: str) -> str:
    before, after = kind["quotes"]
    return before + name.replace(after, after * 2) + after


def _as_text(key: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.hex(key)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(key).cast("string")
    return key.cast("string")


def _utc(micros: str) -> str:
    time = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=int(micros))
    return time.isoformat(sep=" ", timespec="microseconds")


def _literal_maker(kind: dict, dtype: T.DataType):
    if isinstance(dtype, T.NumericType):
        return str
    if isinstance(dtype, T.BooleanType):
        return lambda text: kind["booleans"][text == "true"]
    if isinstance(dtype, T.DateType):
        return "CAST('{}' AS date)".format
    if isinstance(dtype, T.TimestampType):
        return lambda micros: kind["instant"].format(_utc(micros))
    if isinstance(dtype, T.TimestampNTZType):
        return kind["time"].format
    if isinstance(dtype, T.BinaryType):
        return kind["binary"].format
    if isinstance(dtype, T.StringType):
        return lambda text: kind["text"].format(text.replace("'", "''"))
    raise TypeError(f"no key ranges for keys of type {dtype.simpleString()}")
