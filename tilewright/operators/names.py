"""Filters on lists of databases, schemas and other names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tilewright.functions.columns import contains_ignore_case

# Names that belong to the server.
SYSTEM_DATABASES = ("master", "model", "msdb", "tempdb")
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog")
SYSTEM_SCHEMA_PATTERNS = ("pg_toast%", "pg_temp%")


def user_databases(databases: DataFrame) -> DataFrame:
    """Online databases that are not the server's own."""
    return databases.where(
        (F.col("state_desc") == "ONLINE") & ~F.col("name").isin(*SYSTEM_DATABASES)
    ).select("name")


def user_pg_databases(databases: DataFrame) -> DataFrame:
    """Databases that accept connections and are not templates."""
    return databases.where(~F.col("datistemplate") & F.col("datallowconn")).select("datname")


def user_schemas(schemata: DataFrame) -> DataFrame:
    """Schemas that are not the server's own. ``_`` in the patterns matches any character."""
    wanted = ~F.col("schema_name").isin(*SYSTEM_SCHEMAS)
    for pattern in SYSTEM_SCHEMA_PATTERNS:
        wanted &= ~F.col("schema_name").like(pattern)
    return schemata.where(wanted).select("schema_name")


def name_search(df: DataFrame, col: str, text: str) -> DataFrame:
    """Rows whose name contains ``text``, ignoring case."""
    return df.where(contains_ignore_case(F.col(col), text))
