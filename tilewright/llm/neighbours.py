"""Approximate nearest neighbours by collision counting.

Vectors are scaled to unit length and projected on random lines. Per line, a block of
vectors is one sorted array. A query opens a window around its own place on every
line; all windows widen together, round by round, and a vector collides with the query
once for every line on which it lies in the window. Vectors with enough collisions are
verified by their exact cosine.

Every vector is indexed, in blocks of bounded size. The queries visit every block, in
blocks as well; the best of all blocks are ranked in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, all components finite numbers, not all zero."""
    value = F.col(vector)
    finite = F.forall(
        value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    return value.isNotNull() & finite & F.exists(value, lambda x: x != 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length in double precision, by way of the largest component."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of original vectors: dot product over the product of the norms, in doubles."""
    dots = np.einsum("ij,j->i", others, query)
    return dots / (np.sqrt(np.einsum("ij,ij->i", others, others)) * np.sqrt(np.einsum("j,j->", query, query)))


class Index:
    """The sorted arrays of one block of vectors."""

    def __init__(self, vectors: np.ndarray, lines: np.ndarray):
        self.lines = lines
        places = unit(vectors) @ lines
        self.order = np.argsort(places, axis=0, kind="stable")
        self.sorted = np.take_along_axis(places, self.order, 0)

    def candidates(
        self, queries: np.ndarray, share: float, enough: int, width: float, factor: float
    ) -> Iterator[np.ndarray]:
        """Per query the numbers of vectors that collide on ``share`` of the lines.

        Windows widen by ``factor`` until ``enough`` vectors collide often enough. A wider
        window only counts what it newly covers at its two ends; the first one, which covers
        most of a line, takes away what lies outside.
        """
        n, many = self.sorted.shape
        places = unit(queries) @ self.lines
        enough = min(enough, n)
        threshold = int(np.ceil(share * many))
        columns = [np.ascontiguousarray(self.sorted[:, j]) for j in range(many)]
        orders = [np.ascontiguousarray(self.order[:, j]) for j in range(many)]

        def bounds(at: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
            low = [np.searchsorted(c, at[:, j] - half) for j, c in enumerate(columns)]
            high = [np.searchsorted(c, at[:, j] + half, "right") for j, c in enumerate(columns)]
            return np.array(low), np.array(high)

        hits = np.full((len(queries), n), many, np.int16)
        low, high = bounds(places, width)
        for q in range(len(queries)):
            outside = [o[:a] for o, a in zip(orders, low[:, q])] + [o[b:] for o, b in zip(orders, high[:, q])]
            hits[q] -= np.bincount(np.concatenate(outside), minlength=n).astype(np.int16)
        waiting, half = np.arange(len(queries)), width
        while True:
            done = (hits[waiting] >= threshold).sum(1) >= enough
            for q in waiting[done]:
                yield q, np.flatnonzero(hits[q] >= threshold)
            waiting = waiting[~done]
            if not len(waiting):
                return
            half *= factor
            wider = bounds(places[waiting], half)
            for i, q in enumerate(waiting):
                fresh = [o[a:b] for o, a, b in zip(orders, wider[0][:, i], low[:, q])]
                fresh += [o[a:b] for o, a, b in zip(orders, high[:, q], wider[1][:, i])]
                hits[q] += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int16)
            low[:, waiting], high[:, waiting] = wider


def nearest(
    df: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    lines: int = 96,
    share: float = 0.85,
    candidates: int = 600,
    width: float = 1.0,
    factor: float = 1.1,
    block: int = 8192,
    query_block: int = 4096,
    together: int = 512,
    seed: int = 42,
) -> DataFrame:
    """The ``k`` nearest rows by cosine of every query, approximately.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but
    the query's own. Columns: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``, the
    cosine of the original vectors in double precision. Equal scores go to the lesser id.

    Vectors that are null, all zero, or hold nulls or numbers that are not finite take no
    part, nor do rows without an id. Vectors of different lengths are never near each
    other. With fewer candidates than ``k``, all of them are returned. Rows that repeat an
    id are candidates of their own; as queries, only one row of an id counts (that with the
    least vector). An empty table gives an empty result.

    The rows are copied once for every ``query_block`` queries, whose collisions are
    counted ``together`` at a time, so that a task's memory does not grow with that block.
    """
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).filter(F.col("vec_id").isNotNull() & usable("vector"))
    rows = rows.withColumn("size", F.size("vector"))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    queries = queries.groupBy("vec_id", "size").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-rows.count() // block))
    query_blocks = max(1, -(-queries.count() // query_block))
    # Each vector goes to its block, once for every block of queries, and each query to all blocks.
    one = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("part")
    all_query = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_part")
    indexed = rows.select("vec_id", "vector", "size", one, all_query)
    own = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).alias("query_part")
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("part")
    asked = queries.select("vec_id", "vector", "size", own.cast("int").alias("query_part"), all_parts)

    def search(members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(members) and len(asking):
            members, asking = members.sort_values("vec_id", kind="stable"), asking.sort_values("vec_id")
            vectors = np.array(members["vector"].tolist(), np.float64)
            wanted = np.array(asking["vector"].tolist(), np.float64)
            ids = members["vec_id"].to_numpy()
            drawn = np.random.default_rng(seed).standard_normal((vectors.shape[1], lines))
            index = Index(vectors, drawn)
            keys_asked = asking["vec_id"].tolist()
            for start in range(0, len(wanted), together):
                found = index.candidates(wanted[start : start + together], share, candidates + k, width, factor)
                for q, near in found:
                    key, query = keys_asked[start + q], wanted[start + q]
                    near = near[ids[near] != key]
                    score = cosines(query, vectors[near])
                    best = np.lexsort((ids[near], -score))[:k]
                    out["query_id"] += [key] * len(best)
                    out["vec_id"] += ids[near][best].tolist()
                    out["score"] += score[best].tolist()
        return pd.DataFrame(out)

    keys = ["part", "query_part", "size"]
    found = indexed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double"
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
