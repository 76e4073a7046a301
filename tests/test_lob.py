from decimal import Decimal

from fixtures import make_catalog
from pyspark.sql import functions as F

from tilewright.operators import dedup_profile, lob_columns, lob_profile, lob_split
from tilewright.operators.lob import LOB_PROFILE, lob_profiles
from tilewright.session import local_frame


def test_lob_columns(spark):
    c = make_catalog(
        spark,
        tables=[(1001, 1, "t", 0)],
        columns=[
            (1001, 1, "unbounded", 167, -1),
            (1001, 2, "bounded", 167, 100),
            (1001, 3, "old_text", 35, 16),  # listed type, but its length is 16
            (1001, 4, "doc", 241, -1),  # unbounded, but not a listed type
            (1001, 5, "blob", 165, -1),
            (9999, 1, "orphan", 167, -1),
        ],
    )
    found = lob_columns(c.columns, c.tables, c.schemas, c.types).collect()
    assert sorted(r.column for r in found) == ["blob", "unbounded"]
    assert {(r.object_id, r.schema, r.table) for r in found} == {(1001, "main", "t")}


def test_profile(spark):
    df = local_frame(
        spark,
        [("x" * 1024, b"a"), ("x" * 1025, None), (None, None), ("x" * 3_000_000, None)],
        "text string, `odd``name` binary",
    )
    rows = {r.LOBColName: r for r in lob_profile(df, 7, ["text", "odd`name"]).collect()}
    text = rows["text"]
    assert (text.object_id, text.CountLess1KAndNulls) == (7, 2)
    assert text.MaxLOBSizeKB == Decimal("2929.6875")
    assert (text.AvgSizeKB, text.MinSizeKB) == ((3_002_049 // 3) // 1024, 1)
    assert (text.MaxSizeMB, text.AvgSizeMB, text.MinSizeMB) == (2, 0, 0)
    assert rows["odd`name"].CountLess1KAndNulls == 4
    assert rows["odd`name"].MaxLOBSizeKB == Decimal("0.0009760")


def test_profile_of_nothing(spark):
    empty = local_frame(spark, [], "text string")
    row = lob_profile(empty, 1, ["text"]).collect()[0]
    assert [row[c] for c in row.asDict() if c not in ("object_id", "LOBColName")] == [None] * 7
    nulls = lob_profile(local_frame(spark, [(None,)], "text string"), 1, ["text"]).collect()[0]
    assert nulls.CountLess1KAndNulls == 1 and nulls.AvgSizeKB is None
    assert lob_profiles(spark, [], {}).columns == lob_profile(empty, 1, ["text"]).columns


def test_profile_utf16(spark):
    df = local_frame(spark, [("é" * 600,)], "text string")
    assert lob_profile(df, 1, ["text"], utf16=["text"]).collect()[0].CountLess1KAndNulls == 0
    wide = local_frame(spark, [("a" * 600,)], "text string")
    assert lob_profile(wide, 1, ["text"]).collect()[0].CountLess1KAndNulls == 1
    assert lob_profile(wide, 1, ["text"], utf16=["text"]).collect()[0].CountLess1KAndNulls == 0


def test_one_scan_per_table(spark, tmp_path):
    path = str(tmp_path / "t")
    local_frame(spark, [("a", "b", 1)], "x string, y string, z int").write.parquet(path)
    df = spark.read.parquet(path)
    lobs = [(1, "main", "t", "x"), (1, "main", "t", "y")]
    plan = lob_profiles(spark, lobs, {"main.t": df})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<x:string,y:string>" in plan


def test_dedup(spark):
    def row(object_id, name, small):
        return (object_id, name, small, Decimal(small), 0, 0, 0, 0, 0)

    profile = local_frame(
        spark, [row(1, "a", 5), row(1, "a", 9), row(1, "b", 1), row(2, "a", 2)], LOB_PROFILE
    )
    kept = dedup_profile(profile).select("object_id", "LOBColName", "CountLess1KAndNulls").collect()
    assert sorted(map(tuple, kept)) == [(1, "a", 9), (1, "b", 1), (2, "a", 2)]


def test_split_matches_profile_count(spark):
    df = local_frame(spark, [(1, None), (2, "x" * 10), (3, "x" * 11), (4, "")], "id int, v string")
    small, large = lob_split(df, "v", small_bytes=10)
    assert sorted(r.id for r in small.collect()) == [1, 2, 4]
    assert [r.id for r in large.collect()] == [3]
    assert lob_profile(df, 1, ["v"], small_bytes=10).select(F.max("CountLess1KAndNulls")).first()[0] == 3
