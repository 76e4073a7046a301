from decimal import Decimal

from fixtures import make_catalog, make_report, report_row

from tilewright.operators import (
    final_report,
    leading_key_column,
    partition_info,
    rollup_by_table,
    table_report,
)
from tilewright.operators.lob import LOB_PROFILE
from tilewright.session import local_frame


def test_partition_info(spark):
    c = make_catalog(
        spark,
        tables=[(1001, 1, "one", 0), (1002, 1, "many", 0), (100, 1, "system", 0)],
        indexes=[(1001, 0, 0), (1001, 2, 0), (1002, 1, 1), (100, 1, 0), (9999, 1, 0)],
        partitions=[
            (1001, 0, 1, 5), (1001, 2, 1, 5), (1002, 1, 1, 3), (1002, 1, 2, 4), (100, 1, 1, 9), (9999, 1, 1, 1),
        ],
    )
    info = {r.object_id: (r.rows, r.PartitionCount) for r in partition_info(c.tables, c.indexes, c.partitions).collect()}
    assert info == {1001: (5, 0), 1002: (7, 2)}


def test_table_report(spark):
    c = make_catalog(
        spark,
        schemas=[(1, "main"), (2, "other")],
        tables=[
            (1001, 1, "b", 0), (1002, 1, "a", 0), (1003, 2, "empty", 0),
            (1004, 1, "DTlog", 0), (1005, 1, "shipped", 1), (1006, 1, "no_partitions", 0),
        ],
        indexes=[(i, 1, 1) for i in range(1001, 1007)],
        partitions=[(i, 1, 1, 10) for i in (1001, 1002, 1004, 1005)] + [(1003, 1, 1, 0)],
    )
    profile = local_frame(
        spark,
        [
            (1001, "x", 4, Decimal("2.5"), 1, 0, 0, 0, 0),
            (1001, "y", 1, Decimal("9.5"), 1, 0, 0, 0, 0),
            (1003, "z", None, None, None, None, None, None, None),
        ],
        LOB_PROFILE,
    )
    rows = {(r.TableName, r.ConcatenatedLOBs): r for r in table_report(c, profile).collect()}
    assert set(rows) == {("b", "x"), ("b", "y"), ("a", ""), ("empty", "z")}
    assert [rows[k].ID for k in [("b", "y"), ("b", "x"), ("a", ""), ("empty", "z")]] == [1, 2, 3, 4]
    # An empty table with a LOB column has a LOB of size 0.
    empty = rows["empty", "z"]
    assert (empty.ContainsLOBs, empty.CountLess1KAndNulls, empty.MaxLOBSizeKB) == ("Yes", 0, 0)
    assert (empty.Type, empty.Table_JSON, empty.TableSize) == (None, "", "Small")
    assert rows["a", ""].ContainsLOBs == "No"


def test_rollup(spark):
    report = make_report(
        spark, report_row(1, "t", 10, lob="x", kb="5"), report_row(2, "t", 10, lob="y", kb="7"), report_row(3, "u", 1)
    )
    rows = {r.TableName: tuple(r)[2:] for r in rollup_by_table(report).collect()}
    assert rows == {"t": (0, 10, "Yes", Decimal(7)), "u": (0, 1, "No", Decimal(0))}


def test_final_report(spark):
    report = make_report(
        spark, report_row(1, "small", 1), report_row(2, "load_report", 99), report_row(3, "big", 50), report_row(4, "unknown", None)
    )
    assert [r.TableName for r in final_report(report).collect()] == ["big", "small", "unknown"]


def test_leading_key(spark):
    c = make_catalog(
        spark,
        tables=[(1001, 1, "pair", 0), (1002, 1, "heap", 0), (1003, 1, "unique_only", 0)],
        columns=[(1001, 1, "a", 56, 4), (1001, 2, "b", 56, 4), (1003, 1, "u", 56, 4)],
        indexes=[(1001, 1, 0), (1001, 5, 1), (1002, 0, 0), (1003, 1, 0)],
        index_columns=[(1001, 1, 1, 1), (1001, 5, 1, 2), (1001, 5, 2, 1), (1003, 1, 1, 1)],
    )
    keys = {r.TableName: r.first_column for r in leading_key_column(c).collect()}
    assert keys == {"pair": "b", "heap": None, "unique_only": None}
