"""Column expressions shared by the operators. All of them stay inside JVM codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

KB = 1024
MB = 1024 * 1024


def byte_length(col: Column, utf16: bool = False) -> Column:
    """Stored size in bytes: UTF-8 by default, two bytes per UTF-16 unit with ``utf16``."""
    return F.octet_length(F.encode(col, "UTF-16LE") if utf16 else col)


def exact_kb(size: Column) -> Column:
    """Bytes as KB, cut (not rounded) after six decimals, as decimal(18,7)."""
    micro_kb = (size.cast("bigint") * F.lit(1_000_000).cast("bigint"))
    whole = _div(micro_kb, KB).cast("decimal(24,0)")
    return (whole / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,7)")


def whole_kb(size: Column) -> Column:
    return _div(size, KB).cast("int")


def whole_mb(size: Column) -> Column:
    return _div(size, MB).cast("int")


def whole_average(col: Column) -> Column:
    """Integer average, cut towards zero; null when no value is present."""
    return F.call_function("div", F.sum(col.cast("bigint")), F.nullif(F.count(col), F.lit(0).cast("bigint")))


def size_class(rows: Column, bounds: Sequence[int] = (10_000, 50_000, 100_000)) -> Column:
    """Small / Medium / Large / Extra_Large; a shared edge falls to the smaller class."""
    small, medium, large = bounds
    return (
        F.when(rows < small, "Small")
        .when(rows.between(small, medium), "Medium")
        .when(rows.between(medium, large), "Large")
        .otherwise("Extra_Large")
    )


def tile_count(rows: Column, row_limit: int, max_tiles: int = 10) -> Column:
    """How many key ranges a table is loaded in; null when the row count is unknown."""
    tiles = F.least(F.lit(max_tiles).cast("bigint"), _div(rows, row_limit) + 1)
    return F.when(rows.isNotNull(), tiles).cast("int")


def contains_ignore_case(col: Column, text: str) -> Column:
    return F.contains(F.lower(col), F.lower(F.lit(text)))


def _div(col: Column, by: int) -> Column:
    return F.call_function("div", col.cast("bigint"), F.lit(by).cast("bigint"))


def quoted(name: str) -> str:
    """A column name that is taken as it is, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
