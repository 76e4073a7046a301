"""SimHash near-duplicates with pivot distance tables.

A fingerprint's bit is the majority among the hashes of a text's shingles. Copies
share a fingerprint, so all that follows works on distinct ones. Two fingerprints
within the allowed distance agree on at least one of a few parts of their bits;
only those that do meet. A part's value that is shared by too many is divided by
the bits that remain, in the same lossless way. Where they meet, a table of Hamming
distances to many reference fingerprints (the pivots) discards pairs: distances to
a pivot differ by no more than the fingerprints do. Survivors are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import map_columns, store

SEED = 42
AT_ONCE = 1 << 16  # shingles of a long text whose bits are held at the same time


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = text.encode().lower().split()  # bytes: letters A-Z and separators of ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    set_bits, count = np.zeros(64, np.int64), 0
    hashes = (digest(s, SEED) for s in shingles)
    while len(some := np.fromiter(islice(hashes, AT_ONCE), np.uint64)):
        bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(0, dtype=np.int64)
        count += len(some)
    return int(np.packbits(set_bits * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(
    df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed long, of every row."""

    def make():
        def rows(ids, texts):
            for key, text in zip(ids, texts):
                value = fingerprint(text or "", shingle)
                yield key, value - (value >> 63 << 64)

        return rows

    chosen = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_columns(chosen, "doc_id long, bits long", make)


# Links


def part_masks(free: int, parts: int) -> list[int]:
    """The set bits of ``free`` dealt to ``parts`` masks, as evenly as they go, in order."""
    bits = [b for b in range(64) if free >> b & 1]
    cuts = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def signed(value: int) -> int:
    return value - (value >> 63 << 64)


def pivots(count: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**64, count, np.uint64)


def linked(groups: list[np.ndarray], distance: int, references: np.ndarray) -> Iterator[tuple]:
    """For groups of distinct fingerprints, pairs that hold each group's links together.

    Not every link is returned, but enough that what is connected stays connected.
    """
    values = np.concatenate(groups).view(np.uint64)
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    table = np.bitwise_count(values[:, None] ^ references[None, :]).astype(np.int8)
    order = np.lexsort((values, table[:, 0], owner))
    values, owner, table = values[order], owner[order], table[order]
    label = np.arange(len(values))
    low, high = [], []
    left = np.arange(len(values))
    for step in range(1, len(values)):
        left = left[left + step < len(values)]
        right = left + step
        # Sorted by group and first pivot: once out of reach, later ones are as well.
        near = (owner[left] == owner[right]) & (table[right, 0] - table[left, 0] <= distance)
        left, right = left[near], right[near]
        if not left.size:
            break
        kept = np.abs(table[left] - table[right]).max(1) <= distance
        a, b = left[kept], right[kept]
        true = np.bitwise_count(values[a] ^ values[b]) <= distance
        low.append(a[true])
        high.append(b[true])
    if not low:
        return
    low, high = np.concatenate(low), np.concatenate(high)
    while True:
        least = np.minimum(label[low], label[high])
        if (label[low] == least).all() and (label[high] == least).all():
            break
        np.minimum.at(label, low, least)
        np.minimum.at(label, high, least)
        label = label[label]
    own = np.flatnonzero(label != np.arange(len(label)))
    signed_values = values.view(np.int64)
    yield from zip(signed_values[own].tolist(), signed_values[label[own]].tolist())


def links(
    distinct: DataFrame,
    distance: int = 2,
    pivot_count: int = 16,
    group_limit: int = 2048,
    levels: int = 3,
) -> DataFrame:
    """Pairs ``a``, ``b`` of fingerprints in ``bits`` that connect all within ``distance`` bits.

    A group is the fingerprints that agree on a mask of bits. Each level splits the
    bits not yet agreed on into ``distance + 1`` parts, one of which any linked pair
    has equal. Groups above ``group_limit`` go to the next level. After the last one
    so few bits are free that a group has a bound of its own: with three levels and
    distance 2, 20 bits, so at most about a million values of 8 bytes.
    """
    references = pivots(pivot_count)

    def make():
        def rows(groups):
            sets = [np.array(g, np.int64) for g in groups]
            start = size = 0
            for i, group in enumerate(sets):
                size += len(group)
                if size >= 50_000 or i + 1 == len(sets):
                    yield from linked(sets[start : i + 1], distance, references)
                    start, size = i + 1, 0

        return rows

    whole = (1 << 64) - 1
    members = distinct.select("bits", F.lit(0).cast("long").alias("mask"))
    known = {0}
    found = None
    for level in range(levels):
        children = {m: [m | p for p in part_masks(whole & ~m, distance + 1)] for m in known}
        options: Column = F.lit(None)
        for mask, masks in children.items():
            listed = F.array(*(F.lit(signed(m)) for m in masks))
            options = F.when(F.col("mask") == signed(mask), listed).otherwise(options)
        known = {m for masks in children.values() for m in masks}
        keyed = members.select("bits", F.explode(options).alias("mask")).withColumn(
            "key", F.col("bits").bitwiseAND(F.col("mask"))
        )
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("size")).filter("size > 1")
        keyed = store(keyed.join(sizes, ["mask", "key"]), f"simhash-level{level}")
        last = level + 1 == levels
        small = keyed if last else keyed.filter(F.col("size") <= group_limit)
        grouped = small.groupBy("mask", "key").agg(F.collect_list("bits").alias("bits"))
        pairs = map_columns(grouped.select("bits"), "a long, b long", make)
        found = pairs if found is None else found.unionByName(pairs)
        members = keyed.filter(F.col("size") > group_limit).select("bits", "mask").distinct()
        if last or members.isEmpty():
            break
    return found.distinct()


# Components


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """``node`` and the least node ``root`` connected with it, for every node of an edge.

    Alternates two steps until nothing changes: every node sends its larger, then its
    smaller neighbours to the least one. Each round is written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    edges = store(edges.distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(
            small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = store(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def near_duplicates(
    df: DataFrame,
    shingle: int = 3,
    distance: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> DataFrame:
    """Per row of ``df`` its fingerprint and the component of near-duplicates it is in.

    Returns ``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id`` (the
    least id reachable over links of at most ``distance`` bits) and ``group`` (a digest
    of the component that is there even when all its ids are null).

    A null text counts as empty; texts without a word have fingerprint zero and are
    linked like any other. Null ids are left out of the least id. Repeated rows give
    one row each, an empty table an empty result. ``options`` are those of :func:`links`.
    """
    marked = store(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    distinct = store(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "distinct")
    member = components(links(distinct.select("bits"), distance, **options))
    member = distinct.join(member.withColumnRenamed("node", "bits"), "bits", "left")
    member = member.withColumn("root", F.coalesce("root", "bits"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = member.join(least, "root").select("bits", "root", "component_id")

    def digits(column: str) -> Column:
        return F.lower(F.lpad(F.hex(column), 16, "0"))

    return marked.join(member, "bits").select(
        "doc_id", digits("bits").alias("fingerprint"), "component_id", digits("root").alias("group")
    )


def keep_one(
    df: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``df`` with one document of each group of near-duplicates: that with the least id.

    Rows that repeat an id and its text count as one document; an id may have several
    texts, each of which is a document. Of a group without any id one row stays.
    """
    names = df.columns
    whole = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"))
    ids = F.col(f"_row.`{id_col}`").cast("long")
    marked = near_duplicates(df, shingle, distance, id_col, text_col, **options)
    # Narrow rows choose; the documents themselves meet only the ids that stay.
    chosen = marked.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = chosen.groupBy("group").agg(F.min("doc_id").alias("_id"), F.min("fingerprint").alias("_print"))
    several = marked.groupBy("doc_id").agg((F.min("fingerprint") < F.max("fingerprint")).alias("_several"))
    several = several.filter("_several").withColumnRenamed("doc_id", "_id")
    named = store(chosen.filter("_id is not null").join(several, "_id", "left").drop("group"), "simhash-kept")

    def first_copy(rows: DataFrame, *keys: str) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.xxhash64(F.col(f"_row.`{text_col}`")))
        return rows.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").select("_row.*")

    identified = whole.withColumn("_id", ids)
    kept = first_copy(identified.join(named.filter("_several is null"), "_id", "left_semi"), "_id")
    # Ids with texts of different fingerprints: the fingerprint tells which text stays.
    unclear = named.filter("_several")
    if not unclear.isEmpty():
        rows = fingerprints_of(identified.join(unclear, "_id", "left_semi"), shingle, text_col)
        rows = rows.withColumn("_id", ids).join(unclear, ["_id", "_print"], "left_semi")
        kept = kept.unionByName(first_copy(rows, "_id", "_print"))
    # Groups in which no row has an id: one row each, found by fingerprint.
    nameless = chosen.filter("_id is null").select("_print")
    rest = whole.filter(ids.isNull())
    if rest.isEmpty():
        return kept
    printed = fingerprints_of(rest, shingle, text_col)
    rest = printed.join(nameless, "_print").dropDuplicates(["_print"]).select("_row.*")
    return kept.unionByName(rest)


def fingerprints_of(rows: DataFrame, shingle: int, text_col: str) -> DataFrame:
    """Rows in ``_row`` with their fingerprint ``_print`` in hexadecimal digits."""

    @F.pandas_udf("string")
    def digits(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: format(fingerprint(t or "", shingle), "016x"))

    return rows.select("_row", digits(F.col(f"_row.`{text_col}`")).alias("_print"))
