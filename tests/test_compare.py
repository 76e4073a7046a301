import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tilewright.operators import column_stats, compare_buckets, compare_rows, compare_tables, distinct_counts, sequence_positions
from tilewright.operators.compare import PRIMES, _both_sides, _by_key, bucket_digests
from tilewright.session import local_frame

DDL = "k int, a string, b double"


def compared(spark, source, target, **options):
    rows = compare_tables(local_frame(spark, source, DDL), local_frame(spark, target, DDL), ["k"], **options)
    return {r.k: (r.status, r.source_rows, r.target_rows, r.changed_columns) for r in rows.collect()}


def test_keyed(spark):
    source = [(1, "x", 1.0), (2, "x", None), (3, None, 3.0), (4, "x", float("nan")), (5, "x", 5.0), (6, None, None)]
    target = [(1, "x", 1.0), (2, "x", None), (3, "y", 3.5), (4, "x", float("nan")), (6, "z", None), (7, "x", 7.0)]
    assert compared(spark, source, target) == {
        3: ("changed", 1, 1, "a,b"),
        5: ("missing", 1, 0, ""),
        6: ("changed", 1, 1, "a"),
        7: ("extra", 0, 1, ""),
    }


def test_equal_sides(spark):
    rows = [(1, "x", 1.0), (1, "x", 1.0), (None, None, None)]
    assert compared(spark, rows, list(reversed(rows))) == {}


def test_repeated_key(spark):
    source = [(1, "a", 1.0)] * 3 + [(1, "b", 1.0)]
    target = [(1, "a", 1.0)] * 2 + [(1, "c", 1.0)]
    assert compared(spark, source, target) == {1: ("changed", 2, 1, "a")}


def test_repeated_key_paired_anew(spark):
    source, target = [(1, "1", 2.0), (1, "2", 1.0)], [(1, "1", 1.0), (1, "2", 2.0)]
    assert compared(spark, source, target) == {1: ("changed", 2, 2, "a,b")}


def test_repeated_key_middle_value(spark):
    source = [(1, "1", 1.0), (1, "5", 2.0), (1, "9", 3.0)]
    target = [(1, "1", 2.0), (1, "6", 3.0), (1, "9", 4.0)]
    assert compared(spark, source, target) == {1: ("changed", 3, 3, "a,b")}


def test_other_columns_are_an_error(spark):
    one, other = local_frame(spark, [(1,)], "k int"), local_frame(spark, [(1, 2)], "k int, extra int")
    with pytest.raises(ValueError, match="extra"):
        compare_rows(one, other)


def test_digest(spark):
    source = [(1, "x" * 9999, 1.0), (2, "y", 2.0), (3, None, 3.0)]
    target = [(1, "x" * 9998, 1.0), (2, "y", 2.0), (3, "", 3.0)]
    assert compared(spark, source, target, digest=["a"]) == {
        1: ("changed", 1, 1, "a"),
        3: ("changed", 1, 1, "a"),
    }


def test_rows(spark):
    source = local_frame(spark, [(1, "x", 1.0)] * 3 + [(2, None, None)], DDL)
    target = local_frame(spark, [(1, "x", 1.0)] + [(3, "z", 0.0)] * 2, DDL)
    rows = compare_rows(source, target).collect()
    assert sorted(tuple(r) for r in rows if r.k != 2) == [(1, "x", 1.0, 2, 0), (3, "z", 0.0, 0, 2)]
    assert [tuple(r) for r in rows if r.k == 2] == [(2, None, None, 1, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_rows_against_except_all(spark, seed):
    source = spark.range(2000).select(
        F.floor(F.rand(seed) * 50).alias("a"), F.when(F.rand(seed + 9) > 0.1, F.floor(F.rand(seed + 5) * 3)).alias("b")
    )
    stored = source.collect()
    source = local_frame(spark, [tuple(r) for r in stored], "a bigint, b bigint")
    target = local_frame(spark, [tuple(r) for r in stored[:1500] + stored[:100]], "a bigint, b bigint")
    found = compare_rows(source, target)
    for surplus, left, right in (("source_surplus", source, target), ("target_surplus", target, source)):
        lost = left.exceptAll(right).groupBy("a", "b").count().collect()
        got = found.where(F.col(surplus) > 0).select("a", "b", surplus).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, lost)))


@pytest.mark.parametrize("buckets, sub_buckets", [(1, 1), (3, 2), (1 << 14, 1 << 10)])
def test_buckets_find_what_whole_tables_do(spark, buckets, sub_buckets):
    rng = random.Random(buckets)
    rows = [(rng.choice([None, *range(40)]), rng.choice("abc"), rng.choice([None, 0.0, 1.5])) for _ in range(300)]
    changed = [(k, a, b) if rng.random() > 0.05 else (k, "z", b) for k, a, b in rows[:-5]] + [(77, "new", None)]
    source, target = local_frame(spark, rows, DDL), local_frame(spark, changed, DDL)
    found = compare_buckets(source, target, ["k"], buckets=buckets, sub_buckets=sub_buckets).collect()
    wanted = compare_tables(source, target, ["k"]).collect()
    assert found and sorted(map(repr, found)) == sorted(map(repr, wanted))


def test_equal_buckets_move_no_rows(spark, tmp_path):
    """Rows in another order, nulls and both zeros: the digests agree and no second reading follows."""
    path = str(tmp_path / "t")
    rows = [(i, None if i % 5 == 0 else "x" * 5000, -0.0 if i % 2 else float("nan")) for i in range(200)]
    local_frame(spark, rows, DDL).write.parquet(path)
    source = spark.read.parquet(path)
    target = source.orderBy(F.desc("k")).withColumn("b", F.when(F.col("b") == 0, 0.0).otherwise(F.col("b")))
    found = compare_buckets(source, target, ["k"])
    assert found.collect() == []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()


def test_digests_shuffle_no_texts(spark, tmp_path):
    path = str(tmp_path / "t")
    local_frame(spark, [(1, "x" * 5000, 1.0)], DDL).write.parquet(path)
    both = _both_sides(spark.read.parquet(path), spark.read.parquet(path))
    digests = bucket_digests(both, ["k", "a", "b"], ["k"], 16)
    plan = digests._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange")]
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "a#" not in above.replace("Sum", "")
    assert [(r.source_rows, r.target_rows, r.differs) for r in digests.collect()] == [(1, 1, False)]


NESTED = "k int, m map<string,int>, l array<struct<x:int,y:string>>, n map<int,map<int,double>>"


def test_nested_and_map_columns(spark):
    """Maps agree whatever their order; nulls have their place."""
    rows = [
        (1, {"a": 1, "b": 2}, [{"x": 1, "y": None}], {1: {2: 0.5, 3: None}}),
        (2, None, [], {}),
        (3, {"a": None}, [{"x": None, "y": "1"}, None], None),
    ]
    other = [
        (1, {"b": 2, "a": 1}, [{"x": 1, "y": None}], {1: {3: None, 2: 0.5}}),
        (2, {}, [], {}),
        (3, {"a": None}, [None, {"x": None, "y": "1"}], None),
    ]
    source, target = spark.createDataFrame(rows, NESTED), spark.createDataFrame(other, NESTED)
    for compare in (compare_tables, compare_buckets):
        found = {r.k: (r.status, r.changed_columns) for r in compare(source, target, ["k"]).collect()}
        assert found == {2: ("changed", "m"), 3: ("changed", "l")}


def test_very_large_surplus(spark):
    """Counts beyond 2^31 and 10^10 rows of one key: the arithmetic holds."""
    from tilewright.operators.compare import _by_key

    rows = [(1, "a", 1.0, 20_000_000_000, 0), (1, "b", 1.0, 0, 30_000_000_000)]
    wide = local_frame(spark, rows, DDL + ", source_surplus bigint, target_surplus bigint")
    found = _by_key(wide, ["k", "a", "b"], ["k"]).first()
    assert tuple(found) == (1, "changed", 20_000_000_000, 30_000_000_000, "a")


def test_no_join_in_plan(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("a"))
    plan = compare_tables(df, df.withColumn("a", F.lit(2)), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("kind", ["int", "string", "double", "struct<x:double,y:int>", "map<int,double>"])
def test_rows_move_by_key_and_not_their_sums(spark, tmp_path, kind):
    """The sums of all columns are many times as wide as a row: they come after the last shuffle."""
    path, ddl = str(tmp_path / "t"), f"k {kind}, " + ", ".join(f"v{i} double" for i in range(10))
    spark.createDataFrame([], ddl).write.parquet(path)
    df = spark.read.parquet(path)
    found = compare_tables(df, df.withColumn("v0", F.lit(2.0)), ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    later, earlier = plan[: plan.index("Exchange")], plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 2 and "partial_min" in later and "min(" not in earlier


def by_hand(source, target):
    """Of repeated keys: rows that are on one side more often, and the columns whose values are in other proportions."""
    found = {}
    for key in {r[0] for r in source + target}:
        counts = [Counter(r[1:] for r in side if r[0] == key) for side in (source, target)]
        left, right = counts[0] - counts[1], counts[1] - counts[0]
        rows = left.total(), right.total()
        if not any(rows):
            continue
        if not all(rows):
            found[key] = ("missing" if rows[0] else "extra", *rows, "")
            continue
        changed, varied = [], []
        for i, name in enumerate("ab"):
            sides = [Counter(), Counter()]
            for side, unequal in zip(sides, (left, right)):
                for row, n in unequal.items():
                    side[row[i]] += n
            values = set(sides[0]) | set(sides[1])
            if any(sides[0][v] * rows[1] != sides[1][v] * rows[0] for v in values):
                changed.append(name)
            if len(values) > 1:
                varied.append(name)
        found[key] = ("changed", *rows, ",".join(changed or varied))
    return found


@pytest.mark.parametrize("kind", ["int", "double", "struct<x:double>"])
def test_repeated_keys_by_hand(spark, kind):
    rng = random.Random(kind)

    def rows(n):
        return [(rng.choice([None, *range(30)]), rng.choice("ab"), rng.choice([None, 0.0, 1.5])) for _ in range(n)]

    source, target = rows(150), rows(130)
    k = F.struct(F.col("k").cast("double").alias("x")) if kind.startswith("struct") else F.col("k").cast(kind)
    k = F.when(F.col("k").isNotNull(), k)
    sides = [local_frame(spark, side, DDL).withColumn("k", k) for side in (source, target)]
    wanted = by_hand(source, target)
    found = {}
    for r in compare_tables(*sides, ["k"]).collect():
        key = r.k.x if kind.startswith("struct") and r.k is not None else r.k
        found[key] = (r.status, r.source_rows, r.target_rows, r.changed_columns)
    assert found == wanted and len({w[3] for w in wanted.values()}) > 2


def test_keys_that_count_as_one(spark):
    """Both zeros are one key, as are all that are not a number, wherever their rows come from."""
    source = [(0.0, "x"), (float("nan"), "x"), (None, "x")]
    target = [(-0.0, "y"), (float("nan"), "y"), (None, "y")]
    sides = [local_frame(spark, rows, "k double, a string").repartition(3) for rows in (source, target)]
    found = compare_tables(*sides, ["k"]).collect()
    assert sorted(repr(r.k) for r in found) == ["0.0", "None", "nan"]
    assert {tuple(r)[1:] for r in found} == {("changed", 1, 1, "a")}


def test_key_in_other_case(spark):
    sides = [local_frame(spark, [(1, a, 1.0), (2, "x", 1.0)], DDL) for a in "xy"]
    assert [tuple(r) for r in compare_tables(*sides, ["K"]).collect()] == [(1, "changed", 1, 1, "a")]


@pytest.mark.parametrize("times", PRIMES)
def test_surplus_of_a_prime(spark, times):
    """Counts that are zero by one of the moduli of the sums are told by the other."""
    rows = [(1, "a", 1.0, times, 0), (1, "b", 1.0, 0, times), (2, "a", 1.0, times, 0), (2, "a", 2.0, 0, 1)]
    wide = local_frame(spark, rows, DDL + ", source_surplus bigint, target_surplus bigint")
    found = {r.k: tuple(r)[1:] for r in _by_key(wide, ["k", "a", "b"], ["k"]).collect()}
    assert found == {1: ("changed", times, times, "a"), 2: ("changed", times, 1, "b")}


def test_sequences(spark):
    frames = {
        "t": (local_frame(spark, [(3,), (9,), (None,)], "k int"), "k"),
        "empty": (local_frame(spark, [], "k int"), "k"),
    }
    rows = {r.table_name: (r.key_column, r.last_value, r.next_value) for r in sequence_positions(frames).collect()}
    assert rows == {"t": ("k", 9, 10), "empty": ("k", None, 1)}


def test_stats(spark):
    df = local_frame(
        spark, [(1, "b", [1]), (2, None, [1]), (2, "a", None)], "i int, s string, l array<int>"
    )
    for exact in (True, False):
        rows = {r.column_name: tuple(r)[2:] for r in column_stats(df, "t", exact_distinct=exact).collect()}
        assert rows == {
            "i": (3, 0, 2, "1", "2"),
            "s": (3, 1, 2, "a", "b"),
            "l": (3, 1, 1, None, None),
        }


def test_bitmaps_of_any_number(spark):
    """Negative, sparse, null and repeated values; a long span is counted without bitmaps."""
    rng = random.Random(4)
    rows = [(rng.choice([None, -(2**31), 2**31 - 1, *range(-70_000, 70_000, 997)]), rng.randrange(-128, 128),
             rng.choice([None, True, False]), rng.choice([-(2**63), 2**63 - 1, 0]), None) for _ in range(3000)]
    df = local_frame(spark, rows, "i int, b tinyint, t boolean, l bigint, nothing date")
    for span in (1, 1 << 18, 1 << 26):
        found = {r.column_name: r.distinct_count for r in distinct_counts(df, bitmap_span=span).collect()}
        assert found == {c: len({r[i] for r in rows} - {None}) for i, c in enumerate(df.columns)}
    assert {r.distinct_count for r in distinct_counts(df.limit(0)).collect()} == {0}


def test_bitmaps_shuffle_no_values(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).select(F.col("id").alias("k.1"), F.lit("wide").alias("other")).write.parquet(path)
    counts = distinct_counts(spark.read.parquet(path), ["k.1"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "bitmap_construct_agg" in plan and "other" not in plan
    assert counts.first().distinct_count == 100_000
