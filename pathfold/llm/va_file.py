"""Exact top-k search by a vector-approximation file.

Every block of vectors is quantised dimension by dimension into ``2 ** bits``
cells of like population; the file keeps, per vector, the numbers of its cells
(a byte a dimension), and per cell its least and largest value.  A query's
product with the cells bounds its score with every vector from both sides.

First pass, over the cells alone: each query's k-th largest lower bound over all
blocks.  No vector whose upper bound is below it can be among the k best.  Second
pass: in each block the exact vectors that are left are read in the order of
their upper bounds, until the k-th score found is above the next bound.

Scale: the approximation is an eighth of the vectors in doubles and all that the
first pass reads and moves.  A task holds one block of vectors and one of
queries.  What moves is (rows / query_rows) * vectors + (rows / block_rows) *
queries, so larger blocks move less and hold more memory.  A query's bounds and
results are cut to k per block before they are shuffled.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .vector_blocks import array, exact_products, exact_range, ids_of, met, numbered, packed, whole_vectors

_CHUNK = 256  # queries whose bounds with a block are held at once


def quantise(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells (n x d bytes) of the values, and each cell's least and largest value
    (cells x d); cells are cut at quantiles of the dimension's own values."""
    n, d = vectors.shape
    count = 1 << bits
    cells = np.zeros((n, d), dtype=np.uint8)
    low, high = np.zeros((count, d)), np.zeros((count, d))
    at = np.unique(np.linspace(0, n, count + 1).astype(np.int64)[1:-1])
    for j in range(d):
        values = np.sort(vectors[:, j])
        edges = np.unique(values[at[at < n]])
        cells[:, j] = np.searchsorted(edges, vectors[:, j], "right")
        starts = np.concatenate([[0], np.searchsorted(values, edges, "left")])
        ends = np.concatenate([starts[1:], [n]])
        there = starts < ends
        low[:len(starts), j][there] = values[starts[there]]
        high[:len(starts), j][there] = values[ends[there] - 1]
    return cells, low, high


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray, upper: bool) -> np.ndarray:
    """Upper (or lower) bounds of the products of all queries with all quantised vectors."""
    columns = np.arange(cells.shape[1])
    least, most = low[cells, columns], high[cells, columns]
    if not upper:
        least, most = most, least
    return np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T


def read_in_order(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, upper: np.ndarray, candidates: np.ndarray, k: int
                  ) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and scores of the k best candidates (ties to the smaller id), and how
    many exact vectors were read: in order of ``upper``, until no bound left
    reaches the k-th score."""
    order = candidates[np.argsort(-upper[candidates], kind="stable")]
    rows, scores, at, step = order[:0], np.zeros(0, dtype=np.int64), 0, 2 * k
    while at < len(order):
        if at >= k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            if upper[order[at]] < kth:
                break
        some = order[at:at + step]
        rows, scores = np.concatenate([rows, some]), np.concatenate([scores, exact_products(vectors[some], query)])
        at, step = at + len(some), step * 2
    best = np.lexsort((ids[rows], ~scores))[:k]
    return rows[best], scores[best], at


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64, id_col: str = "vec_id", vec_col: str = "embedding",
           bits: int = 5, block_rows: int = 8192, query_rows: int = 1024) -> DataFrame:
    """query_id, rank (from 1), ``id_col``, score: for every row for which
    ``is_query`` (a condition on the column ``id``) holds, the ``k`` rows with the
    largest inner product of ``floor(scale * x)`` components, ties to the smaller id.

    The result is exact whatever ``bits`` and the sizes of blocks.  Rows without
    an id, or with a null vector or a null or non-finite component, are neither
    queries nor candidates; zero vectors are both.  Rows of the query's own id are
    no candidates for it; another repeated row is one as often as it is there; of
    an id that is there several times, the least vector is the query.  Vectors of
    different length are no candidates for each other.  Scores beyond a long's
    range are cut to it.  An empty table, or no query, gives no rows; other
    columns are not looked at.
    """
    if not 1 <= bits <= 8 or k < 1:
        raise ValueError("bits must be 1 to 8 and k positive")
    own = numbered(whole_vectors(vectors, id_col, vec_col, scale), "va-vectors")
    asked = numbered(own.where(is_query).groupBy("id").agg(F.min("vec").alias("vec")), "va-queries")
    n_blocks, n_queries = (max(1, -(-df.count() // rows)) for df, rows in ((own, block_rows), (asked, query_rows)))

    def file(_, exact):
        cells, low, high = quantise(exact, bits)
        return {"cells": cells.tobytes(), "low": low.tobytes(), "high": high.tobytes()}

    blocks = packed(own, n_blocks, "va-file", file, "cells binary, low binary, high binary")
    queries = packed(asked, n_queries, "va-query-blocks", lambda *_: {}, "", key="qblock")

    def scanned(block, upper):
        cells = array(block, "cells", "u1")
        return lambda some: bounds(some, cells, array(block, "low", rows=1 << bits), array(block, "high", rows=1 << bits), upper)

    def lower_bounds(block, query):
        q, qids, ids, lower = array(query, "exact"), ids_of(query), ids_of(block), scanned(block, False)
        if not exact_range(np.concatenate([array(block, c, rows=1 << bits) for c in ("low", "high")]), q):
            return {"query_id": qids[:0], "low": np.zeros(0)}  # no floor from here: the second pass reads more
        found_ids, found = [], []
        for a in range(0, len(q), _CHUNK):
            least = lower(q[a:a + _CHUNK])
            least[qids[a:a + _CHUNK, None] == ids[None, :]] = -np.inf
            top = np.partition(least, max(0, least.shape[1] - k), axis=1)[:, -k:]
            keep = top > -np.inf
            found_ids.append(np.repeat(qids[a:a + _CHUNK], keep.sum(axis=1)))
            found.append(top[keep])
        return {"query_id": np.concatenate(found_ids), "low": np.concatenate(found)}

    lows = met(blocks.drop("exact"), queries, n_blocks, n_queries, lower_bounds, "query_id long, low double")
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))
    kth = lows.withColumn("nth", nth).where(F.col("nth") == k).select(F.col("query_id").alias("id"), F.col("low").alias("floor"))
    # a query with fewer than k candidates has no floor
    floors = packed(asked.join(kth, "id", "left"), n_queries, "va-floors",
                    lambda some, _: {"floors": some["floor"].fillna(-np.inf).to_numpy(dtype="<f8").tobytes()}, "floors binary", key="qblock")

    def exact(block, query):
        q, qids, ids, upper = array(query, "exact"), ids_of(query), ids_of(block), scanned(block, True)
        own_vectors, floor = array(block, "exact"), np.frombuffer(query["floors"], dtype="<f8")
        sure = exact_range(own_vectors, q)
        out = {"query_id": [], "id": [], "score": []}
        for a in range(0, len(q), _CHUNK):
            some = q[a:a + _CHUNK]
            most = upper(some) if sure else np.full((len(some), len(ids)), np.inf)
            open_ = (most >= floor[a:a + _CHUNK, None]) & (qids[a:a + _CHUNK, None] != ids[None, :])
            for i in np.flatnonzero(open_.any(axis=1)):
                rows, scores, _ = read_in_order(own_vectors, ids, some[i], most[i], np.flatnonzero(open_[i]), k)
                out["query_id"].append(np.full(len(rows), qids[a + i]))
                out["id"].append(ids[rows])
                out["score"].append(scores)
        return {c: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for c, v in out.items()}

    found = met(blocks, floors, n_blocks, n_queries, exact, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
