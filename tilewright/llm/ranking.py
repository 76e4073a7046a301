"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser ``m`` form a stratum. Within one, the postings of a
term lie by tf, and as a posting's impact depends on tf and ``m`` alone, it is computed
once per tf. The greatest tf of each term bounds what any document of the stratum can
score: a search visits the strata by falling bound and stops at the first whose bound is
below the score of the k-th document found so far. Equal bounds are still visited, since
ties go to the smaller id.

Two passes over the documents: the texts are read once into rows of (id, length, matched
terms, tf), which are written to the shared folder; from these come the corpus counts, and
then the strata, ordered by range of (m, hash of the id), so that a length that very many
documents share is spread over many tasks. A task holds one portion of its postings at a
time. Items are searched in blocks of at most ``BLOCK_TERMS`` terms (or one item): only
these reach the driver.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tilewright.functions.columns import quoted
from tilewright.session import local_frame, union_all

from .common import store

BLOCK_TERMS = 100_000  # terms of the items that are searched for at the same time
PORTION = 1_000_000  # postings that a task holds at the same time

# What separates terms, and which letters are lower-cased.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TERM_BYTES = bytes(32 if b in SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))

ASKED = pa.schema([("item_id", pa.int64()), ("terms", pa.list_(pa.binary())), ("hash", pa.int64())])
FORWARD = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))]
)
FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("m", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats. After the translation only blanks separate."""
    return text.translate(TERM_BYTES).split()


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents for each item: item_id, rank, doc_id, score, m.

    Null and term-free texts are no documents and match nothing; an item without terms, or
    whose terms no document holds, has no rows. Every other row of ``docs`` is a document of
    its own, so repeated rows are ranked one after the other; a null id comes after all
    others of its score. Rows of ``items`` that repeat an id and a text count once; texts
    that share an id are ranked each on its own. Empty tables give an empty result. Only
    the four named columns are read, so others may have any name.
    """
    spark = docs.sparkSession
    corpus = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"),
        F.col(quoted(text_col)).cast("string").alias("text"),
    ).where("text IS NOT NULL")
    asked = store(
        items.select(
            F.col(quoted(item_col)).cast("long").alias("item_id"),
            F.col(quoted(item_text_col)).cast("string").alias("text"),
        )
        .where("text IS NOT NULL")
        .distinct()
        .mapInArrow(_item_terms, from_arrow_schema(ASKED)),
        "lexical-items",
    )
    wanted = asked.agg(F.sum(F.size("terms")).alias("terms")).first().terms or 0
    blocks = math.ceil(wanted / BLOCK_TERMS)
    found = []
    for block in range(blocks):
        rows = asked.where((F.size("terms") > 0) & (F.pmod("hash", F.lit(blocks)) == block)).collect()
        if rows:
            found.append(_search_block(corpus, rows, k))
    if not found:
        return local_frame(spark, [], "item_id long, rank int, doc_id long, score long, m long")
    return union_all(found)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        terms = [sorted(set(terms_of(t))) for t in texts]
        hashes = [zlib.crc32(b" ".join(t)) for t in terms]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(terms, ASKED.field(1).type), pa.array(hashes, pa.int64())], schema=ASKED
        )


def _search_block(corpus: DataFrame, asked: list, k: int) -> DataFrame:
    spark = corpus.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for item in asked for t in map(bytes, item.terms)}))}
    wanted = [np.array([vocabulary[bytes(t)] for t in item.terms], np.int64) for item in asked]
    forward = store(corpus.mapInArrow(_postings(vocabulary), from_arrow_schema(FORWARD)), "lexical-postings")

    counts = forward.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
    documents, length = counts.docs, counts.length or 1
    weights = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[r.term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["count"] + 1)))

    normaliser = 100 - 90 + F.call_function("div", F.col("n") * (90 * documents), F.lit(length))
    strata = (
        forward.where(F.size("terms") > 0)
        .select("doc_id", normaliser.cast("long").alias("m"), "terms", "tfs")
        .repartitionByRange("m", F.xxhash64("doc_id"))
        .sortWithinPartitions("m")
    )
    best = strata.mapInArrow(_best_of_task(wanted, weights, k), from_arrow_schema(FOUND))
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = local_frame(spark, [(i, r.item_id) for i, r in enumerate(asked)], "item int, item_id long")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .join(names, "item")
        .select("item_id", "rank", "doc_id", "score", "m")
    )


def _postings(vocabulary: dict[bytes, int]):
    """Rows of one document each: its length and, for the wanted terms it holds, their tf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            kept, lengths, ends, terms, tfs = [], [], [0], [], []
            for row, text in enumerate(texts):
                words = terms_of(text.as_py())
                if words:
                    kept.append(row)
                    lengths.append(len(words))
                    for word, tf in Counter(words).items():
                        term = vocabulary.get(word)
                        if term is not None:
                            terms.append(term)
                            tfs.append(tf)
                    ends.append(len(terms))
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                for values in (terms, tfs)
            ]
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64()), *lists], schema=FORWARD)

    return run


class Portion:
    """The strata of some documents: postings ordered by stratum, term and tf."""

    def __init__(self, documents: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        self.documents = documents  # whether the id is null, id, m
        self.m, stratum_of = np.unique(documents[2], return_inverse=True)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        self.stride = int(terms.max(initial=0)) + 1
        key = stratum_of[doc] * self.stride + terms
        order = np.lexsort((tfs, key))
        key, tfs, self.doc = key[order], tfs[order], doc[order]
        # One impact for each run of equal stratum, term and tf.
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tfs[1:] != tfs[:-1])])
        tf, at = tfs[first], self.m[key[first] // self.stride]
        self.impact = np.repeat(1_000_000_000 * tf // (1000 * tf + 8 * at), np.diff(np.r_[first, len(key)]))
        # A list of postings for each stratum and term; its last one has the greatest impact.
        self.start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.end = np.r_[self.start[1:], len(key)]
        self.key = key[self.start]
        self.most = self.impact[self.end - 1]

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each stratum and term, the list and whether there is one."""
        known = terms < self.stride
        wanted = np.arange(len(self.m))[:, None] * self.stride + np.where(known, terms, 0)[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return at, (self.key[at] == wanted) & known[None, :]


class Best:
    """The k best documents of one item so far, by falling score and rising id."""

    def __init__(self, k: int):
        self.k = k
        self.rows = np.empty((4, 0), np.int64)  # score, whether the id is null, id, m

    @property
    def threshold(self) -> int:
        return int(self.rows[0, -1]) if self.rows.shape[1] == self.k else 1

    def add(self, scores: np.ndarray, documents: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.concatenate([scores[None, :], documents])], axis=1)
        self.rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]


def search(portion: Portion, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Visit strata by falling bound until no other can hold a better document; returns how many."""
    at, there = portion.lists(terms)
    bounds = (portion.most[at] * weights[None, :] * there).sum(axis=1)
    order = np.argsort(-bounds, kind="stable")
    visited, step = 0, 1
    while visited < len(order) and bounds[order[visited]] >= best.threshold:
        strata = order[visited : visited + step]
        strata = strata[bounds[strata] >= best.threshold]
        rows, columns = np.nonzero(there[strata])
        lists = at[strata[rows], columns]
        sizes = portion.end[lists] - portion.start[lists]
        skipped = np.repeat(portion.start[lists] - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        postings = skipped + np.arange(len(skipped))
        docs, place = np.unique(portion.doc[postings], return_inverse=True)
        # Sums stay below 2**53, so that doubles hold them exactly.
        parts = portion.impact[postings] * np.repeat(weights[columns], sizes)
        scores = np.bincount(place, weights=parts, minlength=len(docs)).astype(np.int64)
        good = scores >= best.threshold
        best.add(scores[good], portion.documents[:, docs[good]])
        visited += len(strata)
        step *= 2
    return visited


def _best_of_task(wanted: list[np.ndarray], weights: np.ndarray, k: int):
    """The k best documents of a task for each item; what later portions hold is measured by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in wanted]
        for portion in _portions(batches):
            for item, terms in enumerate(wanted):
                search(portion, terms, weights[terms], best[item])
        counts = [b.rows.shape[1] for b in best]
        score, missing, ids, m = np.concatenate([b.rows for b in best], axis=1)
        columns = [
            pa.array(np.repeat(np.arange(len(best)), counts), pa.int32()),
            pa.array(ids, pa.int64(), mask=missing == 1), pa.array(score, pa.int64()), pa.array(m, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

    return run


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[Portion]:
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            held.append(batch.slice(start, 2000))
            size += len(held[-1].column(2).flatten())
            if size >= PORTION:
                yield _portion(held)
                held, size = [], 0
    if size:
        yield _portion(held)


def _portion(held: list[pa.RecordBatch]) -> Portion:
    table = pa.Table.from_batches(held).combine_chunks()
    ids, m, terms, tfs = (table.column(i).combine_chunks() for i in range(4))
    documents = [ids.is_null().cast(pa.int64()), ids.fill_null(0), m]
    return Portion(
        np.stack([column.to_numpy(zero_copy_only=False) for column in documents]),
        terms.value_lengths().to_numpy(zero_copy_only=False),
        terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        tfs.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
    )
