"""Hard-negative mining with segment summaries.

A vector is cut into segments, and of every segment its mean and its deviation
(the length of what is left without the mean) are kept.  For two vectors, a
segment of s components contributes s times the product of the means, plus or
minus at most the product of the deviations (Cauchy-Schwarz); the sums over the
segments bound the score from both sides.  The levels have more and shorter
segments each.  A search begins with the coarsest for all vectors of a block and
goes on with those it could not rule out; what the finest level leaves is scored
exactly.

First search: an anchor's positives, the best rows of its own label.  Second: for
every positive, the best rows of other labels whose score lies in a range that the
positive's score gives; the bounds of an anchor with a row serve all its positives.

Scale: blocks of vectors meet blocks of anchors (see ``vector_blocks``); each
pair returns at most n_positives rows per anchor, or n_negatives per positive.
The blocks and summaries are written once and read by both searches.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .vector_blocks import EXACT, array, exact_products, ids_of, met, numbered, packed, whole_vectors


_CHUNK = 64  # anchors whose bounds with a block are held at once


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means times the square root of the segment's length, and deviations (n x
    segments each): with these, products need no lengths."""
    n, d = vectors.shape
    starts = np.arange(segments) * d // segments
    sizes = np.diff(np.append(starts, d))
    means = np.add.reduceat(vectors, starts, axis=1) / sizes
    apart = np.add.reduceat((vectors - np.repeat(means, sizes, axis=1)) ** 2, starts, axis=1)
    return means * np.sqrt(sizes), np.sqrt(apart)


def score_bounds(means: np.ndarray, deviations: np.ndarray, mean: np.ndarray, deviation: np.ndarray, slack) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible scores, ``slack`` (for what doubles round) further apart."""
    middle, spread = mean @ means.T, deviation @ deviations.T + slack
    return middle - spread, middle + spread


def may_count(low: np.ndarray, high: np.ndarray, ranges: np.ndarray, k: int) -> np.ndarray:
    """Which rows, by their bounds, may be among the ``k`` best of any of the score ranges [from, to]."""
    if not len(ranges) or not len(low):
        return np.zeros(len(low), dtype=bool)
    inside = (low <= ranges[:, 1].max()) & (high >= ranges[:, 0].min())
    if (high - low).min() > (ranges[:, 1] - ranges[:, 0]).max():
        return inside  # no row is sure to be in a range
    keep = np.zeros(len(low), dtype=bool)
    for least, most in ranges:
        sure = low[(low >= least) & (high <= most)]
        floor = least if len(sure) < k else np.partition(sure, len(sure) - k)[len(sure) - k]
        keep |= (low <= most) & (high >= floor)
    return keep


class Summaries:
    """A block's rows and their summaries by level."""

    def __init__(self, block: dict, levels: tuple[int, ...]):
        self.vectors, self.ids = array(block, "exact"), ids_of(block)
        self.labels = np.frombuffer(block["labels"], dtype="<i8")
        self.levels = [(array(block, f"mean{m}", columns=m), array(block, f"dev{m}", columns=m)) for m in levels]
        self.most = float(np.abs(self.vectors).max(initial=0))
        self.scored = 0  # exact scores so far

    def left(self, asked: Summaries, some: slice, rows: list[np.ndarray], ranges: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the queries ``some`` of ``asked``, of each one's ``rows`` those that
        may be among the ``k`` best of any of its score ranges, and their scores.
        A level is worked out for all rows together while most are open, and row
        by row when few are."""
        queries, rows = asked.vectors[some], list(rows)
        many = lambda: sum(map(len, rows)) > 0.1 * len(rows) * len(self.ids)
        most = np.abs(queries).sum(axis=1)[:, None] * self.most
        fine = bool((most < EXACT).all())
        for (means, deviations), (mean, deviation) in zip(self.levels if fine else (), asked.levels):
            mean, deviation, slack, whole = mean[some], deviation[some], 1e-9 * (1 + most), many()
            if whole:
                low, high = score_bounds(means, deviations, mean, deviation, slack)
            for i, own in enumerate(rows):
                bounds = (low[i, own], high[i, own]) if whole else score_bounds(means[own], deviations[own], mean[i], deviation[i], slack[i])
                rows[i] = own[may_count(*bounds, ranges[i], k)]
        self.scored += sum(map(len, rows))
        if fine and many():
            scores = queries @ self.vectors.T
            return [(own, scores[i, own].astype(np.int64)) for i, own in enumerate(rows)]
        return [(own, exact_products(self.vectors[own], query)) for own, query in zip(rows, queries)]


def _best(rows, scores, ids, k):
    best = np.lexsort((ids[rows], ~scores))[:k]
    return rows[best], scores[best]


def mine(vectors: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
         scale: float = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         levels: tuple[int, ...] = (1, 4, 16, 32), block_rows: int = 8192, anchor_rows: int = 512) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.  Scores are inner products of ``floor(scale * x)`` components;
    higher ones come first, ties by smaller id.

    Anchors are the rows for which ``is_anchor`` (a condition on ``id``) holds; an
    anchor's positives are its first ``n_positives`` rows of its label and another
    id; for each of them, the first ``n_negatives`` rows of another label with
    low * positive_score <= 100 * score <= high * positive_score.  A positive
    without such a row gives none.

    Rows without an id or a label, or with a null vector or a null or non-finite
    component, take no part.  A repeated row counts as often as it is there, as a
    positive too; of an anchor id that is there several times, the least (label,
    vector) is the anchor.  Vectors of different length do not meet.  Scores
    beyond a long's range are cut to it.  An empty table gives no rows; other
    columns are not looked at.  Results do not depend on ``levels`` or sizes.
    """
    label = F.col(label_col).cast("long").alias("label")
    own = numbered(whole_vectors(vectors.where(F.col(label_col).isNotNull()), id_col, vec_col, scale, label), "hn-vectors")
    least = own.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("x"))
    anchors = numbered(least.select("id", "x.label", "x.vec"), "hn-anchors")
    n_blocks, n_anchors = (max(1, -(-df.count() // rows)) for df, rows in ((own, block_rows), (anchors, anchor_rows)))

    def summary(some, exact):
        labels = some["label"].to_numpy(dtype="<i8")
        out = {"labels": labels.tobytes()}
        for m in levels:
            means, deviations = summaries(exact, m) if exact.shape[1] >= m else (np.zeros((len(exact), m)), np.full((len(exact), m), np.inf))
            out |= {f"mean{m}": means.astype("<f8").tobytes(), f"dev{m}": deviations.astype("<f8").tobytes()}
        return out

    fields = "labels binary" + "".join(f", mean{m} binary, dev{m} binary" for m in levels)
    blocks = packed(own, n_blocks, "hn-blocks", summary, fields)

    def searched(block, query, own_rows, ranges, k):
        """Anchor number, and the rows and scores that may count, for all anchors of a block."""
        rows, asked = Summaries(block, levels), Summaries(query, levels)
        for a in range(0, len(asked.ids), _CHUNK):
            some = range(a, min(a + _CHUNK, len(asked.ids)))
            own = [np.flatnonzero(own_rows(rows, asked, i)) for i in some]
            for i, (left, scores) in zip(some, rows.left(asked, slice(a, a + _CHUNK), own, [ranges(i) for i in some], k)):
                yield i, asked.ids[i], rows.ids, left, scores

    def positives(block, query):
        out = {"anchor_id": [], "id": [], "score": []}
        alike = lambda rows, asked, i: (rows.labels == asked.labels[i]) & (rows.ids != asked.ids[i])
        for _, anchor, ids, left, scores in searched(block, query, alike, lambda _: np.array([[-np.inf, np.inf]]), n_positives):
            left, scores = _best(left, scores, ids, n_positives)
            for name, x in (("anchor_id", np.full(len(left), anchor)), ("id", ids[left]), ("score", scores)):
                out[name].append(x)
        return _joined(out)

    first = packed(anchors, n_anchors, "hn-anchor-blocks", summary, fields, key="qblock")
    found = met(blocks, first, n_blocks, n_anchors, positives, "anchor_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id"))
    best = found.withColumn("nth", rank).where(F.col("nth") <= n_positives)
    wanted = best.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("nth", F.col("id").alias("positive_id"), "score"))).alias("positives"))

    def with_positives(some, exact):
        told = [[(p["nth"], p["positive_id"], p["score"]) for p in x] for x in some["positives"]]
        flat = np.array([p for x in told for p in x], dtype="<i8").reshape(-1, 3)
        return summary(some, exact) | {"counts": np.array([len(x) for x in told], dtype="<i8").tobytes(), "positives": flat.tobytes()}

    second = packed(anchors.join(wanted, "id"), n_anchors, "hn-positives", with_positives, fields + ", counts binary, positives binary", key="qblock")

    def negatives(block, query):
        counts = np.frombuffer(query["counts"], dtype="<i8")
        told = np.split(np.frombuffer(query["positives"], dtype="<i8").reshape(-1, 3), np.cumsum(counts)[:-1])
        # 100 * score in [low * positive, high * positive], in whole numbers of any size
        ranges = [[(-(-low * int(p[2]) // 100), high * int(p[2]) // 100) for p in own] for own in told]
        wide = lambda i: np.array([r for r in ranges[i] if r[0] <= r[1]], dtype=np.float64).reshape(-1, 2)
        other = lambda rows, asked, i: rows.labels != asked.labels[i]
        out = {c: [] for c in ("anchor_id", "nth", "positive_id", "positive_score", "id", "score")}
        for i, anchor, ids, left, scores in searched(block, query, other, wide, n_negatives):
            for (nth, positive, score), (a, b) in zip(told[i], ranges[i]):
                inside = (scores >= a) & (scores <= b)
                some, its = _best(left[inside], scores[inside], ids, n_negatives)
                for name, x in (("anchor_id", anchor), ("nth", nth), ("positive_id", positive), ("positive_score", score)):
                    out[name].append(np.full(len(some), x))
                out["id"].append(ids[some])
                out["score"].append(its)
        return _joined(out)

    mined = met(blocks, second, n_blocks, n_anchors, negatives,
                "anchor_id long, nth long, positive_id long, positive_score long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "nth").orderBy(F.desc("score"), "id"))
    return (mined.withColumn("rank", rank).where(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def _joined(columns: dict) -> dict:
    return {c: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for c, v in columns.items()}
