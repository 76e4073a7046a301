"""URL rules and host lists held in Bloom filter cascades.

A cascade holds a set of listed keys so that membership is exact for every key of a known
universe, here all keys that the corpus itself yields. Level 1 is a Bloom filter of the
listed keys. Level 2 holds the keys of the universe that level 1 lets pass by mistake,
level 3 the listed keys that level 2 lets pass, and so on until none is left. A key that
first fails at an odd level is not listed, one that first fails at an even level is. The
filters take some ten to twenty bits for each listed key, however large the corpus, and
judging a page needs neither a join nor a shuffle.

Filters are built from bit positions on the executors. Those of one shard of the keys,
``SHARD_BYTES`` at most on average, are in the driver and in a task at the same time; more
listed keys are more shards, which are tested one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tilewright.functions.columns import quoted
from tilewright.session import local_frame

from .common import store

SHARD_BYTES = 32 << 20
LATER_RATE = 1 / 16  # rate of false positives aimed at from level 2 on
BUCKET = 1 << 15  # bits of one row while a filter is collected

# The rules: a verdict, a host with all its subdomains, and the beginning of a path.
RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Cascades


@dataclass(frozen=True)
class Level:
    bits: int
    probes: int
    table: np.ndarray

    def passes(self, number: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found = np.ones(len(first), bool)
        for at in positions(number, self.probes, self.bits, first, second):
            found &= (self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


@dataclass(frozen=True)
class Cascade:
    """The levels of each shard; a key belongs to the shard of its second hash."""

    shards: list[list[Level]]

    def holds(self, shard: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether keys of this shard are listed; False for those of others."""
        listed = np.zeros(len(first), bool)
        left = np.flatnonzero(second.astype(np.int64) % len(self.shards) == shard)
        levels = self.shards[shard]
        for number, level in enumerate(levels, start=1):
            passed = level.passes(number, first[left], second[left])
            listed[left[~passed]] = number % 2 == 0
            left = left[passed]
        listed[left] = len(levels) % 2 == 1
        return listed


def positions(number: int, probes: int, bits: int, first: np.ndarray, second: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of keys, from two 64-bit hashes of each, independent from level to level."""
    start = _mixed(first.astype(np.uint64) + np.uint64(number))
    step = _mixed(second.astype(np.uint64) ^ np.uint64(number)) | np.uint64(1)
    for i in range(probes):
        yield ((start + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    # The two odd factors of a well-known 64-bit finalizer.
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)


def build_cascade(keys: DataFrame, listed: str = "listed", shard_bytes: int = SHARD_BYTES) -> Cascade:
    """A cascade from one row per key of the universe: ``first``, ``second`` and whether it is listed.

    No listed keys give a cascade that lists nothing. ``keys`` is read twice for each shard, so
    it should be stored. Keys count as the same if both 64-bit hashes agree.
    """
    keys = keys.select("first", "second", F.col(listed).alias("listed"))
    sizes = {r.listed: r["count"] for r in keys.groupBy("listed").count().collect()}
    inside, outside = sizes.get(True, 0), sizes.get(False, 0)
    wanted = inside * _bits_per_key(inside, outside) / 8 * 1.5
    count = max(1, math.ceil(wanted / shard_bytes))
    shards = []
    for shard in range(count):
        mine = keys.where(F.pmod("second", F.lit(count)) == shard) if count > 1 else keys
        shards.append(_build_levels(mine.where("listed"), mine.where("NOT listed"), inside, outside))
    return Cascade(shards)


def _bits_per_key(inside: int, outside: int) -> float:
    return (math.log2(max(2, outside / max(1, inside))) + 2 * math.log2(1 / LATER_RATE)) / math.log(2)


def _build_levels(encoded: DataFrame, tested: DataFrame, inside: int, outside: int) -> list[Level]:
    levels, rate = [], min(0.5, inside / max(1, outside))
    while size := encoded.count():
        probes = max(1, round(math.log2(1 / rate)))
        bits = max(64, math.ceil(size * probes / math.log(2)))
        level = Level(bits, probes, _collect_bits(encoded, len(levels) + 1, probes, bits))
        levels.append(level)
        passing = store(tested.mapInArrow(_passing(level, len(levels)), tested.schema), "cascade-level")
        encoded, tested, rate = passing, encoded, LATER_RATE
    return levels


def _collect_bits(keys: DataFrame, number: int, probes: int, bits: int) -> np.ndarray:
    """The filter's bits, or-ed together in rows of ``BUCKET`` bits before they come to the driver."""

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate([*positions(number, probes, bits, *_hashes(batch)), np.empty(0, np.int64)])
            columns = [pa.array(at // BUCKET), pa.array(at % BUCKET)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "place"])

    rows = (
        keys.mapInArrow(set_bits, "bucket long, place long")
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("place").alias("map"))
    )
    table = np.zeros(math.ceil(bits / BUCKET) * BUCKET // 8, np.uint8)
    for r in rows.toLocalIterator():
        table[r.bucket * BUCKET // 8 :][: BUCKET // 8] = np.frombuffer(bytes(r.map), np.uint8)
    return table


def _passing(level: Level, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(level.passes(number, *_hashes(batch))))

    return run


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(n).to_numpy(zero_copy_only=False) for n in ("first", "second"))


def mark_keys(df: DataFrame, cascade: Cascade, first: str, second: str, out: str) -> DataFrame:
    """Add ``out``: for each key of a row, given as two arrays of hashes, whether it is listed."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.BooleanType()))])
    for shard in range(len(cascade.shards)):
        known = shard > 0
        if known:
            df = store(df, "cascade-tested")
        # Only the shard in use is sent to the tasks.
        part = Cascade([levels if i == shard else [] for i, levels in enumerate(cascade.shards)])
        df = df.mapInArrow(_tested(part, shard, first, second, out, known), schema)
    return df


def _tested(cascade: Cascade, shard: int, first: str, second: str, out: str, known: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(first)
            ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
            hashes = (batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in (first, second))
            found = cascade.holds(shard, *hashes)
            columns = dict(zip(batch.schema.names, batch.columns))
            if known:
                found |= columns[out].flatten().to_numpy(zero_copy_only=False)
            columns[out] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


# URLs


def host_of(url: Column) -> Column:
    """What is after the first ``://``, up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_frame(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Rules such as ``allow org/`` as rows: key, number of the host's labels, path length, verdict."""
    rows = []
    for rule in rules:
        verdict, _, key = rule.partition(" ")
        host, slash, path = key.partition("/")
        rows.append((key, host.count(".") + 1, len(slash + path), verdict))
    return local_frame(df.sparkSession, rows, "key string, labels int, length int, verdict string")


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed.

    The longest rule that fits decides (of two equally long ones the one with the longer
    host; a key with both verdicts blocks). A rule fits its host, all subdomains of that, and
    paths that start with the rule's. Where none fits, a page is blocked if its site is
    listed: a site is a host without its last label, and it is listed if rules block more of
    its pages, under any last label, than they allow. ``listed`` says so for every page.

    A null url or one without ``://`` has an empty host and path, which no rule fits and no
    site is. Repeated rows and ids are judged row by row; an empty table gives an empty
    result. Only the two named columns are read, so others may have any name. ``rules`` has
    one row per rule (``rule_frame``); only its pairs of label count and path length reach
    the driver.
    """
    url = F.coalesce(F.col(quoted(url_col)).cast("string"), F.lit(""))
    urls = pages.select(
        F.col(quoted(id_col)).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    shapes = rules.select("labels", "length").distinct().collect()
    keyed = _with_hashes(urls.withColumn("keys", _fitting_keys(sorted((r.labels, r.length) for r in shapes))))
    marks = [F.bool_or(F.col("verdict").eqNullSafe(v)).alias(v) for v in ("allow", "block")]
    universe = store(
        keyed.select(F.explode("keys").alias("key"), F.lit(None).cast("string").alias("verdict"))
        .unionByName(rules.select("key", "verdict"))
        .groupBy("key")
        .agg(*marks)
        .select(*[h.alias(n) for h, n in zip(hashed(F.col("key")), ("first", "second"))], "allow", "block"),
        "url-keys",
    )
    for verdict in ("allow", "block"):
        keyed = mark_keys(keyed, build_cascade(universe, verdict), "firsts", "seconds", verdict)
    # Keys are ordered by label count, so of equally long ones the last is meant.
    fitting = F.transform(
        F.filter(F.arrays_zip("keys", "allow", "block"), lambda k: k["allow"] | k["block"]),
        lambda k: F.struct(F.length(k["keys"]).alias("size"), k["keys"].alias("key"), k["block"].alias("block")),
    )
    longest = F.aggregate(
        fitting, _nothing(), lambda best, k: F.when(k["size"] >= F.coalesce(best["size"], F.lit(0)), k).otherwise(best)
    )
    ruled = keyed.withColumn("best", longest).select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.col("best.block").alias("blocked"),
        F.regexp_extract("host", r"^(.+)\.[^.]*$", 1).alias("site"),
    )
    ruled = store(ruled, "url-rules")

    sites = _with_hashes(ruled.withColumn("keys", F.array("site")))
    found = mark_keys(sites, build_cascade(_site_list(ruled)), "firsts", "seconds", "flags")
    listed = F.get("flags", F.lit(0))
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(F.coalesce("blocked", listed), "block").otherwise("allow").alias("verdict"),
        listed.alias("listed"),
    )


def _site_list(ruled: DataFrame) -> DataFrame:
    """All sites, and of which rules block more pages than they allow."""
    votes = F.sum(F.when(F.col("blocked"), 1).when(~F.col("blocked"), -1).otherwise(0))
    first, second = hashed(F.col("site"))
    return store(
        ruled.groupBy("site")
        .agg(votes.alias("votes"))
        .select(
            first.alias("first"), second.alias("second"), ((F.col("votes") > 0) & (F.col("site") != "")).alias("listed")
        ),
        "url-sites",
    )


def _nothing() -> Column:
    return F.lit(None).cast("struct<size:int,key:string,block:boolean>")


def _with_hashes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "firsts": F.transform("keys", lambda k: hashed(k)[0]),
            "seconds": F.transform("keys", lambda k: hashed(k)[1]),
        }
    )


def _fitting_keys(shapes: list[tuple[int, int]]) -> Column:
    """Every rule that could fit a url: as many last labels and as much of the path as rules have."""
    labels = F.split("host", r"\.")
    keys = [
        F.when(
            (F.size(labels) >= count) & (F.length("path") >= length),
            F.concat(F.array_join(F.slice(labels, -count, count), "."), F.substring("path", 1, length)),
        )
        for count, length in shapes
    ]
    return F.array_compact(F.array(*keys).cast("array<string>"))
