"""Mixing sources to target weights, in DataFrame operations only.

The words of each source, its documents one after another, are cut into blocks of a
fixed length. A source's target asks for some passes over its blocks and part of a
further one. How many slots each output shard gets of each source is drawn first: the
counts are multinomial, given the exact total of each source. They then allot the
slots: shard after shard takes its count of the source's slot numbers, which map to
blocks through a pseudorandom permutation of the source's block numbers, and blocks
meet the documents in a join by block number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tilewright.functions.columns import quoted

from .common import SEPARATORS, store

ROUNDS = 16  # of a permutation
CHUNK = 4096  # slots that one row is expanded to
BUCKET = 5000  # documents that share a running sum


def word_count(text: Column) -> Column:
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")
    return F.size(words).cast("long")


# Targets


def source_targets(
    totals: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``target`` words for rows of ``source`` and ``source_size``.

    Sources in order of code point, null last, weigh ``weights`` over and over. They
    share ``share`` times all words by weight. None gets more than ``most`` times its
    words; the excess goes to the others by weight until none is above. Sources that
    reach their limit first are those with the fewest words for their weight, so one
    ordered pass of running sums finds them all. The frame is as small as the number
    of sources.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*(F.lit(float(w)) for w in weights))
    frame = totals.withColumn("weight", F.get(listed, F.pmod(place, F.lit(len(weights)))))
    frame = frame.withColumn("limit", most * F.col("source_size"))
    order = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    words = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    frame = frame.withColumn("level", words / weight)
    frame = frame.withColumn("full", F.col("limit") <= F.col("weight") * F.col("level"))
    # Beyond the full ones the level stays that of the first source that is not full.
    level = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * level["level"])
    return frame.select("source", "source_size", "documents", target.cast("double").alias("target"))


# Permutations


def permuted(x: Column, n: Column, *key: Column, inverse: bool = False) -> Column:
    """A pseudorandom permutation of 0 .. n - 1 chosen by ``key``, applied to ``x``.

    In each round a number and its mirror image under a round constant either both
    stay or change places, decided by a hash of the larger; so any n will do.
    """
    rounds = F.sequence(F.lit(ROUNDS - 1 if inverse else 0), F.lit(0 if inverse else ROUNDS - 1))

    def swap(at: Column, number: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, number), n) - at, n)
        coin = F.xxhash64(*key, number, F.greatest(at, mirror)).bitwiseAND(1)
        return F.when(coin == 1, mirror).otherwise(at)

    return F.aggregate(rounds, x, swap)


# The mix


def row_mark(id_col: str, text_col: str, source_col: str) -> Column:
    return F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`"), F.col(f"`{source_col}`"))


def running_sum(df: DataFrame, at: str, value: str, name: str, together: int = 4096) -> DataFrame:
    """Add ``name``: the sum of ``value`` over a source's rows with a lesser number ``at``.

    Numbers are unique within a source. Sums are taken within runs of ``together`` numbers
    and shifted by the sums of the runs before, so that no task holds a large source.
    """
    rows = df.withColumn("_run", F.floor(F.col(at) / together))
    sums = rows.groupBy("source", "_run").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy("source").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift")
    sums = sums.select(F.col("source").alias("_source"), F.col("_run").alias("_of"), shift)
    inside = W.partitionBy("source", "_run").orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    here = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_run") == F.col("_of"))
    return rows.join(sums, here).select(*df.columns, (F.col("_shift") + F.col("_inside")).alias(name))


def placed_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **targets,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their place among their source's words, and the sources with targets.

    Within a source, documents stand in the order of a hash of id and text, so that
    reruns agree. Running sums are taken in buckets of some thousand documents and
    shifted by the sums of the buckets before.
    """
    text = F.col(f"`{text_col}`")
    sized = store(
        df.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(text).alias("size"),
            row_mark(id_col, text_col, source_col).alias("mark"),
        ),
        "mix-sizes",
    )
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    sources = store(source_targets(totals, **targets), "mix-sources")
    known = sources.withColumnRenamed("source", "_source")
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    buckets = F.ceil(F.col("documents") / BUCKET)
    rows = rows.withColumn("bucket", F.pmod("mark", buckets))
    inside = W.partitionBy("source", "bucket").orderBy("mark", "doc_id", "size")
    rows = rows.withColumn("until", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    rows = store(
        rows.select("doc_id", "source", "size", "mark", "source_size", "target", "bucket", "until"),
        "mix-running",
    )
    shift = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    shift = running_sum(shift, "bucket", "bucket_size", "shift")
    shift = store(
        shift.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "shift"),
        "mix-shifts",
    )
    here = F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    start = F.col("shift") + F.col("until") - F.col("size")
    placed = rows.join(shift, here).select(
        "doc_id", "source", "size", "mark", "source_size", "target", start.alias("start")
    )
    return placed, sources


def slot_totals(sources: DataFrame, block: int, shard_slots: int = 4096, seed: int = 42) -> DataFrame:
    """One row per source with slots: their exact ``count``, and the number of output ``shards``.

    A target of 1.3 times a source's words is one pass over all its blocks and a second
    one that stops after 0.3 of the words; the last slot may take part of its block.
    """
    frame = sources.filter("source_size > 0").select(
        "source",
        "source_size",
        F.ceil(F.col("source_size") / block).alias("blocks"),
        F.floor(F.round("target") / F.col("source_size")).alias("passes"),
        F.round("target").cast("long").alias("words"),
    )
    frame = frame.withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
    frame = frame.withColumn("tail", F.col("source_size") - (F.col("blocks") - 1) * block)
    # Where the short last block stands in the order of the pass that is not finished.
    short = permuted(
        F.col("blocks") - 1, F.col("blocks"), F.lit(seed), F.col("source"), F.col("passes"), inverse=True
    )
    frame = frame.withColumn("short", short)
    until_short = F.col("short") * block
    beyond = F.greatest(F.lit(0), F.col("rest") - until_short - F.col("tail"))
    partial = F.when(F.col("rest") <= until_short, F.ceil(F.col("rest") / block)).otherwise(
        F.col("short") + 1 + F.ceil(beyond / block)
    )
    frame = frame.withColumn("count", F.col("passes") * F.col("blocks") + partial)
    total = F.sum("count").over(W.partitionBy())
    frame = frame.withColumn("shards", F.greatest(F.lit(1), F.ceil(total / shard_slots)))
    return frame.filter("count > 0")


def chunked(frame: DataFrame) -> DataFrame:
    """``number`` from 0 to below ``count`` for every row, in two steps, so that many tasks expand a large one."""
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("count") - 1) / CHUNK)))
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frame = frame.select("*", chunks.alias("_chunk")).repartition(tasks, "source", "_chunk")
    first = F.col("_chunk") * CHUNK
    last = F.least(first + CHUNK, F.col("count")) - 1
    return frame.select("*", F.explode(F.sequence(first, last)).alias("number")).drop("_chunk")


def shard_counts(totals: DataFrame, seed: int = 42) -> DataFrame:
    """Draw how many slots of each source every output shard gets: ``source``, ``shard``, ``slots``.

    Each source throws as many times as it has slots, every throw at a shard chosen by a
    hash: multinomial counts that keep the source's total. Shards without slots have no row.
    """
    throw = F.pmod(F.xxhash64(F.lit(seed + 1), "source", "number"), "shards")
    return chunked(totals).groupBy("source", throw.alias("shard")).agg(F.count("*").alias("slots"))


def slots(sources: DataFrame, block: int, shard_slots: int = 4096, seed: int = 42) -> DataFrame:
    """One row per slot of the mix: source, pass, block number, words taken of it, output shard.

    The drawn counts allot the slots: a source's shards take its slot numbers in turn.
    """
    totals = store(slot_totals(sources, block, shard_slots, seed), "mix-totals")
    counts = store(shard_counts(totals, seed), "mix-counts")
    allotted = running_sum(counts, "shard", "slots", "from")
    known = totals.drop("count").withColumnRenamed("source", "_source")
    frame = allotted.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # A shard has as many slots of all sources as ``shard_slots``, give or take, so rows stay small.
    frame = chunked(frame.withColumnRenamed("slots", "count"))
    frame = frame.withColumn("slot", F.col("from") + F.col("number"))
    frame = frame.withColumn("turn", F.floor(F.col("slot") / F.col("blocks")))
    frame = frame.withColumn("at", F.col("slot") - F.col("turn") * F.col("blocks"))
    key = [F.lit(seed), F.col("source"), F.col("turn")]
    frame = frame.withColumn("block", permuted(F.col("at"), F.col("blocks"), *key))
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("tail")).otherwise(block)
    before = F.col("at") * block - F.when(F.col("at") > F.col("short"), block - F.col("tail")).otherwise(0)
    taken = F.when(F.col("turn") < F.col("passes"), length).otherwise(
        F.least(length, F.col("rest") - before)
    )
    frame = frame.select("source", "turn", "block", taken.alias("taken"), "shard")
    # Written, so that joins are planned by its true size, which a few rows of sources hide.
    return store(frame, "mix-slots")


def taken_parts(placed: DataFrame, slot_frame: DataFrame, block: int) -> DataFrame:
    """For every document and block of it that the mix takes: the words taken, by number.

    Columns of ``placed`` and ``turn``, ``shard``, ``first`` and ``past`` (within the document).
    """
    end = F.col("start") + F.col("size")
    numbers = F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    pieces = placed.filter("size > 0").select("*", F.explode(numbers).alias("_block"))
    wanted = slot_frame.select(F.col("source").alias("_source"), "turn", "shard", "block", "taken")
    here = (F.col("_block") == F.col("block")) & F.col("source").eqNullSafe(F.col("_source"))
    base = F.col("block") * block - F.col("start")
    return (
        pieces.join(wanted, here)
        .select(
            *placed.columns,
            "turn",
            "shard",
            F.greatest(base, F.lit(0)).alias("first"),
            F.least(base + F.col("taken"), F.col("size")).alias("past"),
        )
        .filter("past > first")
    )


def mix(
    df: DataFrame,
    block: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **targets,
) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it.

    ``shards`` lists the output shards that hold words of the document, in order.
    A null or wordless text has size 0 and is taken 0 words; a source of such texts only
    has target 0. A null source is a source of its own, sorted last. Documents are taken
    at most twice. Repeated rows are separate documents, one row each; a null id stays
    null; an empty table gives an empty result. Other columns may have any name.
    ``targets`` are the options of :func:`source_targets`.
    """
    placed, sources = placed_documents(df, id_col, text_col, source_col, **targets)
    placed = store(placed, "mix-placed")
    parts = taken_parts(placed, slots(sources, block), block)
    parts = parts.withColumn("taken", F.col("past") - F.col("first"))
    keys = ["doc_id", "source", "size", "source_size", "target", "start"]
    untaken = [F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("shard")]
    # Every document with words meets here, taken or not; starts are unique within a source.
    rest = placed.filter("size > 0").select(*keys, *untaken)
    some = parts.select(*keys, "taken", "shard").unionByName(rest)
    held = F.sort_array(F.collect_set("shard")).alias("shards")
    some = some.groupBy(*keys).agg(F.sum("taken").alias("taken"), held)
    none = placed.filter("size = 0").select(*keys, untaken[0], F.array().cast("array<long>").alias("shards"))
    return some.unionByName(none).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shards"
    )


def mixed_documents(
    df: DataFrame,
    block: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    length_col: str = "n_chars",
    shard_col: str | None = None,
    **targets,
) -> DataFrame:
    """The mix itself as rows with the columns of ``df``: one row per document and pass.

    With ``shard_col``, one row per document, pass and output shard, and that column for the shard.

    A document that a pass takes whole keeps its text as it is. Of others the words taken
    remain, joined by blanks, and ``length_col``, if there, becomes their code points.
    Documents of which nothing is taken, such as those without words, are not in the mix.
    """
    placed, sources = placed_documents(df, id_col, text_col, source_col, **targets)
    parts = taken_parts(store(placed, "mix-placed"), slots(sources, block), block)
    spans = F.sort_array(F.collect_list(F.struct("first", "past")))
    split = ["shard"] if shard_col else []
    parts = parts.groupBy("doc_id", "mark", "start", "turn", "size", *split).agg(
        spans.alias("_spans"), F.sum(F.col("past") - F.col("first")).alias("_taken")
    )
    parts = parts.select(
        F.col("mark").alias("_mark"),
        (F.col("_taken") == F.col("size")).alias("_whole"),
        "_spans",
        *(F.col(c).alias("_shard") for c in split),
    )
    # Repeated rows share a mark, and the parts of all of them meet the first. The row itself is
    # one column, so that no name of the table meets one of these.
    row = F.struct(*(F.col(quoted(c)).alias(c) for c in df.columns)).alias("_row")
    first = F.row_number().over(W.partitionBy("_own").orderBy("_own"))
    marked = df.select(row_mark(id_col, text_col, source_col).alias("_own"), row)
    marked = marked.withColumn("_copy", first).filter("_copy = 1")
    text = F.col("_row").getField(text_col)
    words = F.array_remove(F.split(text, SEPARATORS), "")

    def span(s: Column) -> Column:
        return F.slice("_words", (s["first"] + 1).cast("int"), (s["past"] - s["first"]).cast("int"))

    cut = F.flatten(F.transform("_spans", span))
    both = marked.join(parts, F.col("_own") == F.col("_mark"))
    both = both.withColumn("_words", F.when(~F.col("_whole"), words))
    both = both.withColumn("_new", F.when(F.col("_whole"), text).otherwise(F.array_join(cut, " ")))
    kept = {c: F.col("_row").getField(c) for c in df.columns}
    kept[text_col] = F.col("_new")
    if length_col in kept:
        kept[length_col] = F.length("_new").cast(df.schema[length_col].dataType)
    if shard_col:
        kept[shard_col] = F.col("_shard")
    return both.select(*(value.alias(c) for c, value in kept.items()))
