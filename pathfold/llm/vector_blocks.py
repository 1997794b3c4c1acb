"""Blocks of vectors, and a stated set of query rows sent to all of them.

A block is one row: its vectors, ids and what an operator stores with them (an
approximation, summaries) as little-endian arrays in binary columns.  Blocks are
written once to the shared folder, so a pass that needs the approximation alone
reads no exact vectors.  Every block of vectors meets every block of queries
once, in a task of its own that holds just these two.

Rows are dealt to blocks by a number they get when they are staged, not by their
id: rows with one id, or one vector, are spread like any others.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, staged

#: sums of products below this are exact in doubles
EXACT = float(1 << 53)


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float, *more: Column) -> DataFrame:
    """id, vec (``floor(scale * x)`` of every component x, as doubles) and ``more``
    columns of the rows that take part: those with an id and a vector without
    null or non-finite components, before and after scaling.  Other columns, of
    whatever name, are not looked at."""
    v = F.col(vec_col).cast("array<double>")
    scaled = F.transform(v, lambda x: x * F.lit(float(scale)))
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), scaled.alias("vec"), *more))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, staged, with a ``row`` number of their own."""
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), name)


def packed(rows: DataFrame, n_blocks: int, name: str, build: Callable, fields: str, key: str = "block") -> DataFrame:
    """``rows`` (row, id, vec, ...) in ``n_blocks`` blocks, one row per block and
    vector length: ``key``, dim, n, ids, exact and the ``fields`` that
    ``build(pandas rows, vectors)`` returns as a dict."""
    import pandas as pd

    names = [f.strip().split(" ")[0] for f in fields.split(",") if f.strip()]
    ship(rows.sparkSession)

    def pack(pdf):
        out = []
        for dim, some in pdf.groupby(pdf["vec"].map(len)):
            some = some.sort_values("row", kind="stable")
            vectors = np.floor(np.stack([np.asarray(v, dtype=np.float64) for v in some["vec"]])) + 0.0
            out.append({key: int(pdf[key].iloc[0]), "dim": int(dim), "n": len(some), "ids": some["id"].to_numpy(dtype="<i8").tobytes(),
                        "exact": vectors.astype("<f8").tobytes(), **build(some, vectors)})
        return pd.DataFrame(out, columns=[key, "dim", "n", "ids", "exact", *names])

    schema = f"{key} int, dim int, n int, ids binary, exact binary" + ("" if not names else ", " + fields)
    dealt = rows.withColumn(key, F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
    return staged(dealt.groupBy(key).applyInPandas(pack, schema), name)


def met(blocks: DataFrame, queries: DataFrame, n_blocks: int, n_queries: int, answer: Callable, schema: str) -> DataFrame:
    """What ``answer(block row, query block row)`` returns (a dict of columns) for
    every block and query block of one vector length."""
    import pandas as pd

    left = blocks.withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    ship(blocks.sparkSession)

    def pair(vs, qs):
        own = {v["dim"]: v for v in vs.to_dict("records")}
        out = [pd.DataFrame(answer(own[q["dim"]], q), columns=names) for q in qs.to_dict("records") if q["dim"] in own]
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    return left.groupBy("block", "qblock").cogroup(right.groupBy("block", "qblock")).applyInPandas(pair, schema)


def array(row: dict, name: str, kind: str = "<f8", columns: int | None = None, rows: int | None = None) -> np.ndarray:
    """A binary column as a matrix of ``n`` rows and ``dim`` columns, where not said otherwise."""
    return np.frombuffer(row[name], dtype=kind).reshape(row["n"] if rows is None else rows, row["dim"] if columns is None else columns)


def ids_of(row: dict) -> np.ndarray:
    return np.frombuffer(row["ids"], dtype="<i8")


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as longs; those beyond a long's range are cut to it."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query))
    if most < EXACT:
        return (vectors @ query).astype(np.int64)
    q = [int(x) for x in query]
    sums = (sum(int(x) * y for x, y in zip(v, q)) for v in vectors)
    return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in sums], dtype=np.int64)


def exact_range(vectors: np.ndarray, queries: np.ndarray) -> bool:
    """Whether sums of products of these, bounds included, are exact in doubles."""
    return float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1]) < EXACT
