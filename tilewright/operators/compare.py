"""Comparison of a source table with its loaded copy.

Both sides are folded into one aggregate over whole rows, signed by side, so
there is no join: equal rows cancel out before or in one shuffle, and a key that
holds a large share of the rows cannot pair up with itself. Only unequal rows are
shuffled again, by key.

``compare_buckets`` gives the same result where most rows are equal, as after a load,
without moving them: both sides are first folded into order-free digests of hash buckets of
the key, and only buckets whose digests differ are looked into.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tilewright.functions.columns import quoted
from tilewright.session import materialize

# Buckets of the key, and how many each of them is divided into where it differs.
BUCKETS, SUB_BUCKETS = 1 << 14, 1 << 10
# Sums of hashes are taken modulo these primes, one for either half of a hash: so they fit 64 bits for any count.
PRIMES = (2147483647, 2147483629)


def compare_rows(
    source: DataFrame, target: DataFrame, digest: Iterable[str] = ()
) -> DataFrame:
    """Rows that do not occur equally often on both sides; nulls count as equal.

    ``source_surplus`` and ``target_surplus`` say how many more times the row
    occurs there. Columns in ``digest`` are compared and returned as SHA-256,
    which keeps large objects out of the shuffle. Both sides need the same columns,
    in any order; others are an error that names them.
    """
    return _unequal(_both_sides(source, target), source.columns, set(digest))


def _both_sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """All rows with ``__side``, 1 or -1. Types that differ become their common one here."""
    columns = source.columns
    if set(columns) != set(target.columns):
        only = sorted(set(columns) ^ set(target.columns))
        raise ValueError(f"columns on one side only: {', '.join(only)}")
    sides = [
        df.select(*[quoted(c) for c in columns], F.lit(side).alias("__side")) for df, side in ((source, 1), (target, -1))
    ]
    return sides[0].unionByName(sides[1])


def _unequal(both: DataFrame, columns: Sequence[str], digest: set[str]) -> DataFrame:
    surplus = (
        both.select(*[_comparable(c, digest) for c in columns], "__side")
        .groupBy(*[quoted(c) for c in columns])
        .agg(F.sum("__side").alias("__surplus"))
        .where(F.col("__surplus") != 0)
    )
    return surplus.select(
        *[quoted(c) for c in columns],
        F.greatest(F.col("__surplus"), F.lit(0)).cast("bigint").alias("source_surplus"),
        F.greatest(-F.col("__surplus"), F.lit(0)).cast("bigint").alias("target_surplus"),
    )


def compare_tables(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    digest: Iterable[str] = (),
) -> DataFrame:
    """Keys whose rows differ: missing in the target, extra in it, or changed.

    ``changed_columns`` lists the differing columns in table order. For a repeated
    key the unmatched rows of both sides are compared: a column counts as changed if
    the values occur in different proportions there, told by the sums of both halves of
    their hashes modulo a prime. If none does, values have only been paired anew, and the columns that
    hold several values among those rows are listed.
    """
    return _by_key(compare_rows(source, target, digest), source.columns, keys)


def compare_buckets(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    digest: Iterable[str] = (),
    buckets: int = BUCKETS,
    sub_buckets: int = SUB_BUCKETS,
) -> DataFrame:
    """What ``compare_tables`` returns, shuffling the rows of unequal buckets only.

    Keys are dealt into ``buckets`` by hash and both sides read once for the digest of each
    bucket; what is shuffled then is one narrow row per bucket and task. Unequal buckets are
    divided once more, so that few unequal rows among very many move few equal ones with
    them. Equal tables end after the first reading. Two sides whose rows differ in a bucket
    are told apart by 128 bits of hash sums and the row count.
    """
    columns = source.columns
    both = _both_sides(source, target)
    kept = both
    for level, count in enumerate((buckets, buckets * sub_buckets)):
        unequal = materialize(
            bucket_digests(kept, columns, keys, count).where("differs").select("bucket"), f"unequal-{level}"
        )
        if unequal.isEmpty():
            kept = both.where(F.lit(False))
            break
        # The list is stored, so Spark sees its size and decides how to join it.
        kept = both.withColumn("__bucket", _bucket(keys, count)).join(
            unequal.withColumnRenamed("bucket", "__bucket"), "__bucket", "left_semi"
        )
    return _by_key(_unequal(kept, columns, set(digest)), columns, keys)


def bucket_digests(both: DataFrame, columns: Sequence[str], keys: Sequence[str], buckets: int) -> DataFrame:
    """Per bucket of the key: source_rows, target_rows and whether the rows of the sides differ.

    ``both`` has the rows of both sides with ``__side`` (1 or -1). The digest of a side is
    the sum of two hashes of its rows, each in two halves of 32 bits, so it does not depend
    on their order and is combined before the shuffle. Here the sums of both sides are one,
    zero if they agree; a sum too large for 64 bits counts as different.
    """
    hashes = [F.xxhash64(F.lit(seed), *_hash_inputs(both, columns)) for seed in (0, 1)]
    halves = [h for x in hashes for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))]
    # Hashes are made once per row, in a projection of their own.
    narrow = both.select(
        _bucket(keys, buckets).alias("bucket"), "__side", *[h.alias(f"__h{i}") for i, h in enumerate(halves)]
    )
    sums = [F.try_sum(F.col(f"__h{i}") * F.col("__side")).alias(f"__s{i}") for i in range(len(halves))]
    rows = [F.count_if(F.col("__side") == side).alias(name) for side, name in ((1, "source_rows"), (-1, "target_rows"))]
    differs = F.col("source_rows") != F.col("target_rows")
    for i in range(len(halves)):
        differs = differs | F.coalesce(F.col(f"__s{i}") != 0, F.lit(True))
    return (
        narrow.groupBy("bucket")
        .agg(*rows, *sums)
        .select("bucket", "source_rows", "target_rows", differs.alias("differs"))
    )


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in keys]), F.lit(buckets))


def _hash_inputs(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Values that hash alike only if they are equal: a hash passes over nulls, so these are told too."""
    inputs = []
    for c in columns:
        col, dtype = F.col(quoted(c)), df.schema[c].dataType
        inputs += [_hashable(col, dtype), col.isNull()]
    return inputs


def _hashable(col: Column, dtype: T.DataType) -> Column:
    """A nested value as JSON, where nulls have their place and the entries of maps are in order."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        held = F.struct(_ordered(col, dtype).alias("v"))
        return F.when(col.isNotNull(), F.to_json(held, {"ignoreNullFields": "false"}))
    return col


def _ordered(col: Column, dtype: T.DataType) -> Column:
    """The value with every map in it as an array of its entries by key."""
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(col),
            lambda e: F.struct(
                _ordered(e["key"], dtype.keyType).alias("key"), _ordered(e["value"], dtype.valueType).alias("value")
            ),
        )
        return F.array_sort(entries)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda v: _ordered(v, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [_ordered(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col + F.lit(0.0)  # both zeros are one value
    return col


def _by_key(rows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per key of the unequal ``rows``.

    The rows themselves are shuffled, not sums of them: most keys have few, and the sums of
    all columns are many times as wide as a row. They are made where a key's rows have met,
    in constant memory per key; 2^32 different unmatched rows of a key would be an error.
    """
    values = [c for c in columns if c not in set(keys)]
    rows, places = _by_place(rows, keys)
    # Hashes and their products with the row's count are made once per row, in projections of their own.
    hashes = [F.xxhash64(F.lit(0), *_hash_inputs(rows, [c])).alias(f"__hash_{i}") for i, c in enumerate(values)]
    kept = [*places, *dict.fromkeys(quoted(k) for k in keys), "source_surplus", "target_surplus"]
    hashed = rows.select(*kept, *hashes)
    weighted = []
    for i in range(len(values)):
        x = F.col(f"__hash_{i}")
        for j, half in enumerate((F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))):
            # A row is on one side only, so the sum of both counts is its count there.
            times = (F.col("source_surplus") + F.col("target_surplus")) % PRIMES[j]
            weighted.append(((half % PRIMES[j]) * times % PRIMES[j]).alias(f"__times{j}_{i}"))
    measures = [
        F.sum("source_surplus").alias("source_rows"),
        F.sum("target_surplus").alias("target_rows"),
    ]
    changed, varied = [], []
    for i, c in enumerate(values):
        differs = []
        for j, prime in enumerate(PRIMES):
            for side in ("source", "target"):
                here = F.when(F.col(f"{side}_surplus") > 0, F.col(f"__times{j}_{i}")).otherwise(F.lit(0))
                measures.append(F.sum(here.cast("bigint")).alias(f"__{side}{j}_{i}"))
            products = [
                (F.col(f"__{side}{j}_{i}") % prime) * (F.col(f"{other}_rows") % prime) % prime
                for side, other in (("source", "target"), ("target", "source"))
            ]
            differs.append(products[0] != products[1])
        measures.append((F.min(f"__hash_{i}") != F.max(f"__hash_{i}")).alias(f"__varied_{i}"))
        changed.append(F.when(differs[0] | differs[1], F.lit(c)))
        varied.append(F.when(F.col(f"__varied_{i}"), F.lit(c)))
    both = (F.col("source_rows") > 0) & (F.col("target_rows") > 0)
    status = (
        F.when(both, "changed").when(F.col("source_rows") > 0, "missing").otherwise("extra")
    )
    listed = F.concat_ws(",", *changed)
    listed = F.when(listed != "", listed).otherwise(F.concat_ws(",", *varied))
    return (
        hashed.select(*kept, *[f"__hash_{i}" for i in range(len(values))], *weighted)
        .groupBy(*places, *[quoted(k) for k in keys])
        .agg(*measures)
        .select(
            *[quoted(k) for k in keys],
            status.alias("status"),
            "source_rows",
            "target_rows",
            F.when(both, listed).otherwise("").alias("changed_columns"),
        )
    )


def _by_place(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows shuffled by key, and columns to group by besides the keys so that they are not shuffled again.

    Keys that Spark rewrites to group by them (floating point and nested ones) are placed by a hash.
    """
    plain, places = [], {}
    for i, k in enumerate(keys):
        col, dtype = F.col(quoted(k)), rows.select(quoted(k)).schema[0].dataType
        if isinstance(dtype, (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType)):
            places[f"__place_{i}"] = F.xxhash64(_hashable(col, dtype))
        else:
            plain.append(col)
    if not keys:
        return rows, []
    return rows.withColumns(places).repartition(*plain, *places), list(places)


def _comparable(column: str, digest: set[str]) -> Column:
    col = F.col(quoted(column))
    return F.sha2(col.cast("binary"), 256).alias(column) if column in digest else col
