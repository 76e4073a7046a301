"""Equal-count key ranges of a table, exact and without ordering the table.

``ntile`` over a whole table sends every row to one task. Here the first and
last key of each tile are looked up as order statistics, in a few scans of the
key whatever its values:

1.  Cut keys are proposed: quantiles of a mergeable sketch, which the same scan fills that
    counts the rows, or a sample where keys are not numbers or times.
2.  The rows between and on the cuts are counted. Null keys and keys that are
    cuts take up known positions from here on.
3.  Ranges that hold a wanted position but too many rows for one task are read again and
    cut in the same way, until none is left.
4.  The others are read once more. Their rows are counted per distinct key (combined before
    the shuffle, so a hot key is one row) and ranked range by range, each in a task of its
    own of at most ``MOST_RANKED`` rows.

Reading again means plain range filters that a file scan can skip by. Any cut keys give the
right result: bad ones cost time, not exactness. The driver holds the cut keys of one
step and one count for each.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_left
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tilewright.functions.columns import quoted
from tilewright.session import local_frame

# Cut keys of one step: so many for each tile and so many besides, which settle keys of few
# distinct values at once. With ten rows of a sample for each, or a sketch twice as fine.
CUTS_PER_TILE, CUTS = 4, 1_024
SAMPLE_PER_CUT = 10
SKETCH_MERGES = 64  # tasks that merge sketches before the last one does

# Rows of a range that one task ranks.
MOST_RANKED = 500_000

# Ranges in one file filter; beyond that neighbouring ones are merged.
PUSHED_RANGES = 16


@dataclass(frozen=True)
class Range:
    """Keys between two others, not included (None: no end), and the rows in and before it."""

    low: str | None
    high: str | None
    before: int
    rows: int


Run = tuple[str | None, int, int]  # a key as text, its first and its last position


def range_boundaries(
    df: DataFrame, key: str, tiles: int, cuts: int | None = None, most_ranked: int = MOST_RANKED
) -> DataFrame:
    """Row count, least and greatest key of each of ``tiles`` equal-count tiles in key order.

    Equal to grouping by ``ntile(tiles)`` over the key; null keys come first, and are
    neither least nor greatest beside others.
    With fewer rows than tiles there is one tile per row. Only the key is read.
    ``cuts`` is the number of cut keys of a step and ``most_ranked`` that of rows which a
    task ranks; only the cost depends on them.
    """
    keys = df.select(F.col(quoted(key)).alias("key"))
    dtype = keys.schema["key"].dataType
    total, known, ranges = find_ranges(keys, tiles, cuts or CUTS_PER_TILE * tiles + CUTS, most_ranked)
    size, longer = divmod(total, tiles)

    # A run of equal keys at positions first..last belongs to one or more tiles.
    runs = _ranked_runs(keys, dtype, ranges).unionByName(
        local_frame(df.sparkSession, known, "key string, first bigint, last bigint").withColumn(
            "key", _from_text(F.col("key"), dtype)
        )
    )
    loc = F.explode(
        F.sequence(_tile_of(F.col("first"), size, longer), _tile_of(F.col("last"), size, longer))
    )
    last = F.when(F.col("key").isNotNull(), F.col("last"))
    return (
        runs.select("key", "last", loc.alias("loc"))
        .groupBy(F.col("loc").cast("int").alias("loc"))
        .agg(F.min_by("key", last).alias("min_val"), F.max_by("key", last).alias("max_val"))
        .select(
            "loc",
            F.when(F.col("loc") <= longer, size + 1).otherwise(size).cast("bigint").alias("cnt_vals"),
            "min_val",
            "max_val",
        )
    )


def find_ranges(
    keys: DataFrame, tiles: int, cuts: int, most_ranked: int
) -> tuple[int, list[Run], list[Range]]:
    """All rows, the runs at wanted positions, and the ranges that hold the others, in order.

    No range has more than ``most_ranked`` rows, unless a step proposes no key inside of it.
    """
    dtype = keys.schema["key"].dataType
    total, fences = _propose_cuts(keys, dtype, cuts)
    wanted = _positions(total, tiles)
    counted = _count_places(keys, dtype, fences)
    nulls = counted.get(0, 0)
    if 0 < nulls < total:  # the least key may be in the middle of a tile
        wanted = sorted({*wanted, nulls + 1})
    known, ranges = _settle(counted, fences, range(2 * len(fences) + 2), 0, wanted)
    while large := [r for r in ranges if r.rows > most_ranked]:
        inside = _inside(keys, dtype, large)
        ends = list(dict.fromkeys(k for r in large for k in (r.low, r.high) if k is not None))
        _, fences = _propose_cuts(inside, dtype, cuts, ends)
        if len(fences) == len(ends):
            break
        counted = _count_places(inside, dtype, fences)
        ranges = [r for r in ranges if r.rows <= most_ranked]
        for r in large:
            first = 1 if r.low is None else 2 * fences.index(r.low) + 3
            last = 2 * len(fences) + 1 if r.high is None else 2 * fences.index(r.high) + 1
            runs, parts = _settle(counted, fences, range(first, last + 1), r.before, wanted)
            known += runs
            ranges += parts
        ranges.sort(key=lambda r: r.before)
    return total, known, ranges


def assign_slices(df: DataFrame, key: str, boundaries: DataFrame) -> DataFrame:
    """Add the ``slice`` each row is loaded in: slice t holds the keys from tile t's first
    key up to, not including, the first key of tile t+1. Null keys are in slice 1.

    The boundaries (one key per tile) become constants, so no join is needed.
    """
    dtype = df.schema[key].dataType
    # Equal boundaries (a hot key that fills whole tiles) are passed together.
    passed = {text: i for i, text in enumerate(tile_starts(boundaries, dtype), start=1)}
    place, slices = f"_place_of_{key}", _constant_array([1, *(1 + i for i in passed.values())], "array<int>")
    return (
        _placed(df, key, list(passed), dtype, place)
        .withColumn("slice", F.get(slices, F.shiftright(F.greatest(F.col(quoted(place)), F.lit(1)), 1)))
        .drop(place)
    )


def tile_starts(boundaries: DataFrame, dtype: T.DataType) -> list[str]:
    """The first keys of all tiles but the first as text, in order, without nulls."""
    starts = boundaries.where("loc > 1 AND min_val IS NOT NULL").orderBy("loc")
    return [r.k for r in starts.select(_to_text(F.col("min_val"), dtype).alias("k")).collect()]


def slice_balance(sliced: DataFrame, key: str) -> DataFrame:
    """Rows, smallest and largest key of each slice."""
    return sliced.groupBy("slice").agg(
        F.count(F.lit(1)).alias("cnt_vals"),
        F.min(quoted(key)).alias("min_val"),
        F.max(quoted(key)).alias("max_val"),
    )


def _tile_of(position: Column, size: int, longer: int) -> Column:
    """The tile of a position when the first ``longer`` tiles have one row more than ``size``."""
    past = longer * (size + 1)
    return F.when(
        position <= past, _div(position - 1, size + 1) + 1
    ).otherwise(_div(position - 1 - past, max(size, 1)) + 1 + longer)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def _propose_cuts(
    keys: DataFrame, dtype: T.DataType, cuts: int, ends: list[str] = ()
) -> tuple[int, list[str]]:
    """The rows, and about ``cuts`` keys at even distances with ``ends`` between them, ascending, as text."""
    to_number, from_number = _numeric(dtype)
    if to_number is None:
        total = keys.count()
        fraction = min(1.0, SAMPLE_PER_CUT * cuts / max(total, 1))
        step = F.greatest(F.lit(1), F.call_function("div", F.size("sample"), F.lit(cuts))).alias("step")
        chosen = (
            keys.where("key IS NOT NULL")
            .sample(fraction, seed=0)
            .agg(F.sort_array(F.collect_list("key")).alias("sample"))
            .select("sample", step)
            .select(F.filter("sample", lambda _, i: i % F.col("step") == 0).alias("cuts"))
        )
    else:
        whole = to_number(F.col("key"))
        kind = "double" if dict(keys.select(whole.alias("n")).dtypes)["n"] == "double" else "bigint"
        sketch, merged, quantiles = (
            getattr(F, f"kll_{name}_{kind}") for name in ("sketch_agg", "merge_agg", "sketch_get_quantile")
        )
        fineness = F.lit(max(200, min(65_535, 2 * cuts)))
        # Null where there is no key: a sketch of nothing has no quantiles.
        part = keys.select(whole.alias("n")).groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_MERGES)).alias("part"))
        parts = part.agg(F.count(F.lit(1)).alias("rows"), F.count("n").alias("present"), sketch("n", fineness).alias("s"))
        held = parts.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            merged(F.when(F.col("present") > 0, F.col("s")), fineness).alias("s"),
            F.coalesce(F.sum("present"), F.lit(0)).alias("present"),
        )
        ranks = _constant_array([(i + 0.5) / cuts for i in range(cuts)], "array<double>")
        found = F.when(F.col("present") > 0, quantiles("s", ranks)).otherwise(F.array())
        chosen = held.select("rows", F.array_compact(F.transform(found, from_number)).alias("cuts"))
    ascending = F.array_sort(F.array_distinct(F.concat(_fence_array(list(ends), dtype), "cuts")))
    texts = F.transform(ascending, lambda k: _to_text(k, dtype)).alias("k")
    row = chosen.select(texts, *(["rows"] if to_number else [])).first()
    return row.rows if to_number else total, list(row.k)


def _numeric(dtype: T.DataType):
    """How keys become numbers in the same order and back, about; None for other keys."""
    if isinstance(dtype, T.DateType):
        return (lambda c: F.unix_date(c).cast("bigint")), (lambda n: F.date_from_unix_date(n.cast("int")))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros, F.timestamp_micros
    if isinstance(dtype, T.IntegralType):
        return (lambda c: c.cast("bigint")), (lambda n: n.cast(dtype))
    if isinstance(dtype, T.NumericType):
        return (lambda c: c.cast("double")), (lambda n: n.try_cast(dtype))
    return None, None


def _count_places(keys: DataFrame, dtype: T.DataType, fences: list[str]) -> dict[int, int]:
    counted = _placed(keys, "key", fences, dtype, "place").groupBy("place").count()
    return {r["place"]: r["count"] for r in counted.collect()}


def _placed(df: DataFrame, key: str, fences: list[str], dtype: T.DataType, name: str) -> DataFrame:
    """Add where a key lies among ascending fences: 0 if null, 2j + 1 just below the j-th
    (from 0), 2j + 2 on it.

    A binary search with one projection per step: compiled code that looks up a constant
    array, whatever the number of fences.
    """
    if not fences:
        return df.withColumn(name, F.when(F.col(quoted(key)).isNull(), 0).otherwise(1))
    table, value, passed = _fence_array(fences, dtype), F.col(quoted(key)), F.col(quoted(name))
    df = df.withColumn(name, F.lit(0))
    for power in range(len(fences).bit_length() - 1, -1, -1):
        reached = F.get(table, passed + ((1 << power) - 1)) <= value
        df = df.withColumn(name, passed + F.when(reached, 1 << power).otherwise(0))
    on_fence = F.coalesce(F.get(table, passed - 1) == value, F.lit(False))
    place = F.when(value.isNull(), 0).otherwise(2 * passed + F.when(on_fence, 0).otherwise(1))
    # Through the generator no filter on the place is pushed down: it would unroll the search.
    others = [F.col(quoted(c)) for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(place)).alias(name))


def _positions(total: int, tiles: int) -> list[int]:
    """The first and last position of every tile, ascending."""
    size, longer = divmod(total, tiles)
    positions, end = [], 0
    for loc in range(1, min(tiles, total) + 1):
        positions.append(end + 1)
        end += size + (loc <= longer)
        positions.append(end)
    return positions


def _settle(
    rows_at: dict[int, int], fences: list[str], places: range, before: int, wanted: list[int]
) -> tuple[list[Run], list[Range]]:
    """Of some places in a row, the runs of one key and the ranges that hold a wanted position."""
    known, ranges = [], []
    for place in places:
        rows = rows_at.get(place, 0)
        at = bisect_left(wanted, before + 1)
        if rows and at < len(wanted) and wanted[at] <= before + rows:
            j = place // 2
            if place % 2:
                low, high = fences[j - 1] if j else None, fences[j] if j < len(fences) else None
                ranges.append(Range(low, high, before, rows))
            else:
                known.append((fences[j - 1] if place else None, before + 1, before + rows))
        before += rows
    return known, ranges


def _ranked_runs(keys: DataFrame, dtype: T.DataType, ranges: list[Range]) -> DataFrame:
    """Each distinct key in the ranges with the first and last position it takes up."""
    fences = list(dict.fromkeys(k for r in ranges for k in (r.low, r.high) if k is not None))
    before: list[int | None] = [None] * (2 * len(fences) + 2)
    for r in ranges:
        before[1 if r.low is None else 2 * fences.index(r.low) + 3] = r.before
    rows_before = F.get(_constant_array(before, "array<bigint>"), F.col("place"))
    placed = _placed(_inside(keys, dtype, ranges), "key", fences, dtype, "place")
    counted = placed.where(rows_before.isNotNull()).groupBy("place", "key").agg(F.count(F.lit(1)).alias("n"))
    last = F.sum("n").over(W.partitionBy("place").orderBy("key")) + rows_before
    return counted.withColumn("last", last).select(
        "key", (F.col("last") - F.col("n") + 1).alias("first"), "last"
    )


def _inside(keys: DataFrame, dtype: T.DataType, ranges: list[Range]) -> DataFrame:
    """At least the rows of these ranges, by plain filters that a file scan can skip by."""
    if not ranges:
        return keys.where(F.lit(False))
    group = math.ceil(len(ranges) / PUSHED_RANGES)
    filters = []
    for i in range(0, len(ranges), group):
        low, high = ranges[i].low, ranges[min(i + group, len(ranges)) - 1].high
        bounds = [F.col("key").isNotNull()]
        if low is not None:
            bounds.append(F.col("key") > _from_text(F.lit(low), dtype))
        if high is not None:
            bounds.append(F.col("key") < _from_text(F.lit(high), dtype))
        filters.append(reduce(and_, bounds))
    return keys.where(reduce(or_, filters))


# Keys go through the driver as text, without loss.


def _to_text(key: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.hex(key)
    if isinstance(dtype, T.TimestampType):  # seconds, whatever the time zone
        return (F.unix_micros(key).cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)").cast("string")
    return key.cast("string")


def _from_text(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.unhex(text)
    if isinstance(dtype, T.TimestampType):
        return text.cast("decimal(20,6)").cast(dtype)
    return text.cast(dtype)


def _fence_array(fences: list[str], dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.array(*[F.unhex(F.lit(f)) for f in fences])
    table = _constant_array(fences, "array<string>")
    if isinstance(dtype, T.TimestampType):
        table = table.cast("array<decimal(20,6)>")
    return table.cast(T.ArrayType(dtype))


def _constant_array(values: list, dtype: str) -> Column:
    """One constant, in place of one expression per element."""
    return F.from_json(F.lit(json.dumps(values)), dtype)
