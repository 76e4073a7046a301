"""Hand-made catalogs and reports."""

from __future__ import annotations

from tilewright.operators.report import REPORT
from tilewright.session import local_frame
from tilewright.sources.catalog import (
    COLUMNS,
    INDEX_COLUMNS,
    INDEXES,
    PARTITIONS,
    SCHEMAS,
    TABLES,
    TYPES,
    Catalog,
)

TYPE_ROWS = [(167, "varchar"), (35, "text"), (231, "nvarchar"), (56, "int"), (241, "xml"), (165, "varbinary")]


def make_catalog(
    spark,
    tables=(),
    columns=(),
    indexes=(),
    partitions=(),
    index_columns=(),
    schemas=((1, "main"),),
    types=TYPE_ROWS,
) -> Catalog:
    return Catalog(
        columns=local_frame(spark, columns, COLUMNS),
        tables=local_frame(spark, tables, TABLES),
        schemas=local_frame(spark, schemas, SCHEMAS),
        types=local_frame(spark, types, TYPES),
        indexes=local_frame(spark, indexes, INDEXES),
        partitions=local_frame(spark, partitions, PARTITIONS),
        index_columns=local_frame(spark, index_columns, INDEX_COLUMNS),
    )


def report_row(id_, table, rows, parts=0, lob="", kb="0", schema="main"):
    from decimal import Decimal

    return (
        id_, table, schema, rows, "Partitioned" if parts else "Not Partitioned", parts,
        "Yes" if lob else "No", lob, 0, Decimal(kb), 0, 0, 0, 0, 0, "Small", None, "",
    )


def make_report(spark, *rows):
    return local_frame(spark, rows, REPORT)
