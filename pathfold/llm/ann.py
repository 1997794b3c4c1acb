"""Approximate nearest neighbours by collision counting.

Every projection of a block of vectors is kept as one sorted array.  A query
looks at a window around its own projection in each of them; a vector inside
the window collides with the query there, and one that collides in at least a
share of the projections is verified: its distance is calculated in double
precision on the original vectors.  If too few are close enough, the windows
grow by a factor (virtual rehashing: nothing is hashed again) and the search
goes on; a query ends when its ``k`` best verified distances lie within what
the windows are known to cover.

Scale: the stated queries are searched against all rows in pairs of blocks of
bounded size (a task holds one block of vectors and one of queries); every
pair gives each query's k nearest in it, and a window over a query's few rows
per block gives the result.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, staged


class SortedProjections:
    """The index of a block: ``n_projections`` sorted arrays."""

    def __init__(self, vectors: np.ndarray, n_projections: int, seed: int = 17):
        self.vectors = vectors
        lines = np.random.default_rng(seed).standard_normal((vectors.shape[1], n_projections))
        self.lines = lines
        values = vectors @ lines
        self.order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)
        self.values = np.take_along_axis(np.ascontiguousarray(values.T), self.order, axis=1)

    def nearest(self, queries: np.ndarray, k: int, skip: np.ndarray, ids: np.ndarray, share: float, growth: float):
        """For each query the rows and distances of its k nearest, ties to the
        smaller id; ``skip`` is the id that is not a candidate."""
        n, m = len(self.vectors), self.lines.shape[1]
        need = int(np.ceil(share * m))
        spread = float((self.values[:, -1] - self.values[:, 0]).max()) or 1.0
        for query, own, at in zip(queries, skip, (queries @ self.lines).tolist()):
            width, hits = spread / 32, np.zeros(n, dtype=np.int64)
            low = [int(np.searchsorted(v, x)) for v, x in zip(self.values, at)]
            high = list(low)
            verified = np.zeros(n, dtype=bool)
            rows, dist = np.zeros(0, dtype=np.int64), np.zeros(0)
            while True:
                added = []  # what the wider windows reach beyond the last ones
                for j in range(m):
                    a = int(np.searchsorted(self.values[j], at[j] - width, "left"))
                    b = int(np.searchsorted(self.values[j], at[j] + width, "right"))
                    added += [self.order[j, a:low[j]], self.order[j, high[j]:b]]
                    low[j], high[j] = min(a, low[j]), max(b, high[j])
                hits += np.bincount(np.concatenate(added), minlength=n)
                new = np.flatnonzero((hits >= need) & ~verified)
                verified[new] = True
                new = new[ids[new] != own]
                rows = np.concatenate([rows, new])
                dist = np.concatenate([dist, np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))])
                best = np.lexsort((ids[rows], dist))[:k]
                # a vector at distance r projects to a normal spread of r
                if len(rows) >= k and dist[best[-1]] <= width or all(a == 0 and b == n for a, b in zip(low, high)):
                    break
                width *= growth
            yield rows[best], dist[best]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (doubles) of the rows that take part: not null, not zero, and
    without null or non-finite components."""
    v = F.col(vec_col).cast("array<double>")
    own = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))
    fine = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return own.where(F.col("vec").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("vec", lambda x: x != 0))


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           n_projections: int = 48, share: float = 0.55, growth: float = 1.5, block_rows: int = 16384,
           query_rows: int = 4096) -> DataFrame:
    """query_id, rank (from 1), ``id_col``, score: the ``k`` nearest found of every
    row for which ``is_query`` (a condition on the column ``id``) holds, by
    Euclidean distance, among all rows but those of its own id.

    Rows that cannot take part (see ``usable``) are neither queries nor
    candidates; a repeated row is a candidate as often as it is there, a
    repeated query is answered once; vectors of another length than the query's
    are no candidates for it; an empty table gives no rows.
    """
    # rows are dealt by a number of their own: those with one id, or one vector, do not meet in a block
    own = staged(usable(vectors, id_col, vec_col).withColumn("dim", F.size("vec")).withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    queries = own.where(is_query).dropDuplicates(["id"])
    n, n_queries = own.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    # each block of vectors meets each block of queries once
    left = (own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
            .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.withColumn("qblock", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(query_blocks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    ship(vectors.sparkSession)

    def pair(vs, qs):
        import pandas as pd

        out = []
        for dim, some in qs.groupby("dim"):
            there = vs[vs["dim"] == dim]
            if not len(there):
                continue
            ids = there["id"].to_numpy(dtype=np.int64)
            index = SortedProjections(np.stack(there["vec"].to_list()), n_projections)
            query_ids = some["id"].to_numpy(dtype=np.int64)
            for q, (rows, dist) in zip(query_ids, index.nearest(np.stack(some["vec"].to_list()), k, query_ids, ids, share, growth)):
                out.append(pd.DataFrame({"query_id": q, "id": ids[rows], "score": dist}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})

    found = (left.groupBy("block", "qblock").cogroup(right.groupBy("block", "qblock"))
             .applyInPandas(pair, "query_id long, id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
