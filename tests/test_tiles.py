import datetime
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tilewright.operators import assign_slices, range_boundaries, slice_balance
from tilewright.operators import tiles as tiles_module
from tilewright.session import local_frame

TIGHT = {"cuts": 3}


def by_ntile(keys, tiles, null_first=True):
    """Tiles of the sorted keys, the way ntile deals them out."""
    ordered = sorted(keys, key=lambda k: (k is not None, k))
    size, longer = divmod(len(ordered), tiles)
    found, at = [], 0
    for loc in range(1, tiles + 1):
        n = size + (loc <= longer)
        if n:
            present = [k for k in ordered[at : at + n] if k is not None] or [None]
            found.append((loc, n, present[0], present[-1]))
        at += n
    return found


def boundaries(df, tiles, **limits):
    rows = range_boundaries(df, "k", tiles, **limits).collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("limits", [{}, TIGHT], ids=["many cuts", "few cuts"])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.integers(-20, 20) | st.integers(-(2**62), 2**62), max_size=60),
    tiles=st.integers(1, 12),
)
def test_equals_ntile(spark, limits, keys, tiles):
    df = local_frame(spark, [(k,) for k in keys], "k bigint")
    assert boundaries(df, tiles, **limits) == by_ntile(keys, tiles)


TYPES = {
    "int": lambda r: r.randrange(300),
    "double": lambda r: r.uniform(-5, 5),
    "decimal(20,6)": lambda r: Decimal(r.randrange(10**9)) / 1_000_000,
    "string": lambda r: "".join(r.choice("aé😀Z'\"") for _ in range(6)),
    "binary": lambda r: r.randbytes(3),
    "date": lambda r: datetime.date(2020, 1, 1) + datetime.timedelta(r.randrange(2000)),
    "timestamp": lambda r: datetime.datetime(2020, 1, 1) + datetime.timedelta(microseconds=r.randrange(10**15)),
    "timestamp_ntz": lambda r: datetime.datetime(2020, 1, 1) + datetime.timedelta(microseconds=r.randrange(10**15)),
}


@pytest.mark.parametrize("dtype", TYPES)
def test_key_types(spark, dtype):
    draw = random.Random(3)
    keys = [TYPES[dtype](draw) for _ in range(400)]
    if dtype == "timestamp":
        df = local_frame(spark, [(k,) for k in keys], "k timestamp_ntz").select(F.col("k").cast("timestamp"))
        df_found = range_boundaries(df, "k", 4, cuts=9).withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("min_val", "max_val")}
        )
    else:
        df = local_frame(spark, [(k,) for k in keys], f"k {dtype}")
        df_found = range_boundaries(df, "k", 4, cuts=9)
    plain = lambda v: bytes(v) if isinstance(v, bytearray) else v
    found = sorted(tuple(map(plain, r)) for r in df_found.collect())
    assert found == by_ntile(keys, 4)


def test_null_and_hot_keys(spark):
    keys = [None] * 40 + [7] * 200 + list(range(100, 160))
    df = local_frame(spark, [(k,) for k in keys], "k int")
    for limits in ({}, TIGHT):
        found = {r[0]: tuple(r) for r in range_boundaries(df, "k", 10, **limits).collect()}
        assert [found[i] for i in range(1, 11)] == by_ntile(keys, 10)


def test_many_tiles(spark):
    """More ranges than fit one filter."""
    keys = [None] * 500 + [i * 7 % 20_011 for i in range(20_000)] + [11] * 3_000
    df = local_frame(spark, [(k,) for k in keys], "k bigint")
    ordered = by_ntile(keys, 60)
    for limits in ({}, {"cuts": 1}, {"cuts": 90}, {"cuts": 1_000}):
        found = {r[0]: tuple(r) for r in range_boundaries(df, "k", 60, **limits).collect()}
        assert [found[i] for i in range(1, 61)] == ordered


@pytest.mark.parametrize("count", [0, 1, 2, 24, 63, 64, 100])
def test_places(spark, count):
    fences = [3 * i for i in range(count)]
    df = local_frame(spark, [(k,) for k in [None, *range(-2, 3 * count + 2)]], "k bigint")
    placed = tiles_module._placed(df, "k", [str(f) for f in fences], df.schema["k"].dataType, "place")
    for k, at in placed.collect():
        below = sum(f < k for f in fences) if k is not None else None
        assert at == (0 if k is None else 2 * below + 1 + (k in fences))


def test_ten_thousand_tiles(spark):
    df = spark.range(30_000).select(F.abs(F.xxhash64("id")).alias("k"))
    keys = [r.k for r in df.collect()]
    assert boundaries(df, 10_000) == by_ntile(keys, 10_000)


def test_nothing_but_one_key(spark):
    df = spark.range(500).select(F.lit(3).alias("k"))
    assert boundaries(df, 4, **TIGHT) == [(i, 125, 3, 3) for i in range(1, 5)]
    assert boundaries(df.where("k > 3"), 4) == []


def test_larger_narrowing(spark):
    """A third of the rows on one key."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 77).otherwise(F.abs(F.xxhash64("id")) % 1_000_003).alias("k")
    )
    found = boundaries(df, 10, cuts=700)
    counts = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    keys = [k for k in sorted(counts) for _ in range(counts[k])]
    assert found == by_ntile(keys, 10)


@pytest.mark.parametrize("cuts", [[], ["399"], ["-5", "1000"], ["7", "8", "9"]])
def test_bad_cuts_stay_exact(spark, monkeypatch, cuts):
    monkeypatch.setattr(tiles_module, "_propose_cuts", lambda *_: (400, cuts))
    df = spark.range(400).select(F.col("id").alias("k"))
    assert boundaries(df, 3) == by_ntile(range(400), 3)


def test_many_nulls_and_a_dotted_name(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("a.b")).write.parquet(path)
    found = range_boundaries(spark.read.parquet(path), "a.b", 4).orderBy("loc").collect()
    assert [tuple(r) for r in found] == [
        (1, 5000, None, None), (2, 5000, None, None), (3, 5000, 0, 9998), (4, 5000, 10000, 19998),
    ]


def test_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10_000).select(F.col("id").alias("k"), F.lit("wide").alias("other")).write.parquet(path)
    found = range_boundaries(spark.read.parquet(path), "k", 4, cuts=100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<k:bigint>" in plan
    assert "GreaterThan(k," in plan and "LessThan(k," in plan


@pytest.mark.parametrize("rows", [2_000, 20_000, 200_000])
def test_ranking_tasks_are_bounded(spark, rows):
    """Whatever the number of rows, no task ranks more than so many; the cut keys of a step do not grow."""
    keys = spark.range(rows).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.hash("id")).alias("key"))
    total, known, ranges = tiles_module.find_ranges(keys, 10, 40, 300)
    assert total == rows and 0 < max(r.rows for r in ranges) <= 300 and len(ranges) + len(known) <= 20
    assert [r.before for r in ranges] == sorted(r.before for r in ranges)
    found = sorted(map(tuple, range_boundaries(keys, "key", 10, cuts=40, most_ranked=300).collect()))
    assert found == by_ntile([r.key for r in keys.collect()], 10)


@pytest.mark.parametrize("dtype", TYPES)
def test_cutting_again_by_type(spark, dtype):
    draw = random.Random(7)
    keys = [TYPES[dtype](draw) for _ in range(600)] + [None] * 50
    df = local_frame(spark, [(k,) for k in keys], f"k {dtype.replace('timestamp_ntz', 'timestamp').replace('timestamp', 'timestamp_ntz')}")
    if dtype == "timestamp":
        df = df.select(F.col("k").cast("timestamp"))
    found = range_boundaries(df, "k", 5, cuts=4, most_ranked=20)
    if dtype == "timestamp":
        found = found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("min_val", "max_val")})
    plain = lambda v: bytes(v) if isinstance(v, bytearray) else v
    assert sorted(tuple(map(plain, r)) for r in found.collect()) == by_ntile(keys, 5)


def test_extreme_numbers(spark):
    """Ends of each type's range, both zeros, infinite and undefined values."""
    inf = float("inf")
    for dtype, keys in {
        "double": [-inf, inf, 1e308, -1e308, 0.0, 5e-324, 2.5, 2.5] * 9,
        "decimal(38,0)": [Decimal(10**38 - 1), Decimal(1 - 10**38), Decimal(7), None] * 9,
        "bigint": [2**63 - 1, -(2**63), 0, None] * 9,
        "date": [datetime.date(1, 1, 1), datetime.date(9999, 12, 31), None] * 9,
    }.items():
        df = local_frame(spark, [(k,) for k in keys], f"k {dtype}")
        assert boundaries(df, 4, cuts=3, most_ranked=5) == by_ntile(keys, 4)
    nan = local_frame(spark, [(k,) for k in [float("nan"), 1.0, 2.0, float("nan")]], "k double")
    assert [str(r) for r in boundaries(nan, 2, cuts=2)] == ["(1, 2, 1.0, 2.0)", "(2, 2, nan, nan)"]


def test_few_distinct_keys_are_settled_at_once(spark, tmp_path):
    """The boundaries of keys that are all cuts need no further reading."""
    path = str(tmp_path / "t")
    spark.range(30_000).select((F.col("id") % 50 * 3).alias("k")).write.parquet(path)
    found = range_boundaries(spark.read.parquet(path), "k", 7)
    assert "FileScan" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 7


def test_filters_do_not_unroll_the_search(spark):
    df = spark.range(3_000).select(F.col("id").alias("k"))
    sliced = assign_slices(df, "k", range_boundaries(df, "k", 300))
    assert sliced.where("slice = 7 OR slice > 299").count() == 20


def test_slices_need_no_exchange(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").alias("k")).write.parquet(path)
    df = spark.read.parquet(path)
    plan = assign_slices(df, "k", range_boundaries(df, "k", 4))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_slices(spark):
    df = local_frame(spark, [(k,) for k in [None, 1, 1, 2, 3, 4, 5, 6]], "k int")
    found = range_boundaries(df, "k", 3)
    sliced = assign_slices(df, "k", found)
    starts = [r.min_val for r in found.where("loc > 1").orderBy("loc").collect()]
    assert starts == [2, 5]
    for r in sliced.collect():
        assert r.slice == 1 + sum(r.k is not None and r.k >= s for s in starts)
    balance = {r.slice: tuple(r)[1:] for r in slice_balance(sliced, "k").collect()}
    assert balance == {1: (3, 1, 1), 2: (3, 2, 4), 3: (2, 5, 6)}


@pytest.mark.parametrize("tiles", [1, 9, 60])
def test_slices_of_a_hot_key(spark, tiles):
    keys = [None, *range(0, 400), *[50] * 500, *range(350, 400)]
    df = local_frame(spark, [(k,) for k in keys], "k int")
    found = range_boundaries(df, "k", tiles)
    starts = [r.min_val for r in found.where("loc > 1").orderBy("loc").collect()]
    assert tiles == 1 or len(set(starts)) < len(starts)
    for r in assign_slices(df, "k", found).collect():
        assert r.slice == 1 + sum(r.k is not None and r.k >= s for s in starts)


def test_slices_of_nothing(spark):
    df = local_frame(spark, [(1,), (None,)], "k int")
    none = range_boundaries(df.where("k > 1"), "k", 3)
    assert [r.slice for r in assign_slices(df, "k", none).collect()] == [1, 1]
