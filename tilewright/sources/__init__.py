from tilewright.sources.catalog import (
    Catalog,
    TableSpec,
    build_catalog,
    session_catalog,
    session_databases,
)
from tilewright.sources.jdbc import (
    POSTGRES,
    SQL_SERVER,
    JdbcServer,
    range_predicates,
    read_catalog,
    read_databases,
    read_query,
    read_schemas,
    read_table,
    read_tables,
)

__all__ = [
    "POSTGRES",
    "SQL_SERVER",
    "Catalog",
    "JdbcServer",
    "TableSpec",
    "build_catalog",
    "range_predicates",
    "read_catalog",
    "read_databases",
    "read_query",
    "read_schemas",
    "read_table",
    "read_tables",
    "session_catalog",
    "session_databases",
]
