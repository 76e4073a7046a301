from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tilewright.functions import byte_length, exact_kb, size_class, tile_count, whole_average
from tilewright.session import local_frame


def one(spark, rows, ddl, *columns):
    return [tuple(r) for r in local_frame(spark, rows, ddl).select(*columns).collect()]


def test_byte_length(spark):
    rows = one(spark, [("aé😀",), (None,)], "v string", byte_length(F.col("v")), byte_length(F.col("v"), utf16=True))
    assert rows == [(7, 8), (None, None)]
    assert one(spark, [(b"\x00\x01",)], "v binary", byte_length(F.col("v"))) == [(2,)]


def test_exact_kb_cuts(spark):
    rows = one(spark, [(1,), (1023,), (1024,), (2**31,), (None,)], "v bigint", exact_kb(F.col("v")))
    assert [r[0] for r in rows] == [
        Decimal("0.0009760"), Decimal("0.9990230"), Decimal(1), Decimal(2**21), None,
    ]


def test_whole_average(spark):
    assert one(spark, [(1,), (2,), (None,)], "v int", whole_average(F.col("v"))) == [(1,)]
    assert one(spark, [(None,)], "v int", whole_average(F.col("v"))) == [(None,)]
    assert one(spark, [], "v int", whole_average(F.col("v"))) == [(None,)]


@pytest.mark.parametrize(
    "rows, label",
    [
        (0, "Small"), (9_999, "Small"), (10_000, "Medium"), (50_000, "Medium"),
        (50_001, "Large"), (100_000, "Large"), (100_001, "Extra_Large"), (None, "Extra_Large"),
    ],
)
def test_size_class(spark, rows, label):
    assert one(spark, [(rows,)], "v bigint", size_class(F.col("v"))) == [(label,)]


@pytest.mark.parametrize(
    "rows, tiles",
    [(0, 1), (9_999_999, 1), (10_000_000, 2), (95_000_000, 10), (10**12, 10), (None, None)],
)
def test_tile_count(spark, rows, tiles):
    assert one(spark, [(rows,)], "v bigint", tile_count(F.col("v"), 10_000_000)) == [(tiles,)]
