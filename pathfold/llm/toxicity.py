"""Toxicity by a chain of linear classifiers.

The categories are learned in order; the model of a category sees, besides
its own text features, the probabilities of all earlier categories.  While
learning, those are out-of-fold predictions, so that a later model never sees
an earlier one's answer on rows it was fitted to; scoring uses the final models.

Text features are binary: a word, or the first 4 to 8 bytes of a longer word,
occurs at all, makes up one word in a hundred, or one in thirty.  Per fold and
category the ``features`` with the largest G² against the label are kept, so
the model is a few hundred weights, whatever the corpus.

The models are fitted on at most ``sample_rows`` labelled documents (a bounded
sample by hash of doc_id); scoring covers every document in one pass without
a shuffle.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, map_arrow, staged, text_slices

#: features that a task counts before it hands the sums on
_COUNTED = 50_000

#: shares of a document's words that a unit must reach, by level
LEVELS = (0.0, 1 / 100, 1 / 30)
PREFIXES = range(4, 9)


def units(word: bytes) -> list[bytes]:
    return [word + b"$"] + [word[:k] for k in PREFIXES if k < len(word)]


def document_features(words: list[bytes], wanted=None) -> set[tuple[bytes, int]]:
    counts: Counter = Counter()
    for word, n in Counter(words).items():
        for unit in units(word) if wanted is None else wanted(word):
            counts[unit] += n
    total = len(words)
    return {(u, k) for u, n in counts.items() for k, least in enumerate(LEVELS) if n >= least * total}


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 12) -> np.ndarray:
    """Newton's method for L2-penalised logistic regression; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        w[-1] = -20.0 if len(y) == 0 or y[0] == 0 else 20.0
        return w
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


@dataclass
class Chain:
    """The fitted models: per category its features, weights (features, earlier
    categories' probabilities, constant) and decision threshold."""

    categories: list[str]
    features: list[list[tuple[bytes, int]]] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    #: out-of-fold probabilities and labels, by category
    held_out: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def scorer(self):
        columns = [{f: i for i, f in enumerate(fs)} for fs in self.features]
        known = {u for fs in self.features for u, _ in fs}
        memory: dict[bytes, tuple] = {}

        def wanted(word):
            got = memory.get(word)
            if got is None:
                if len(memory) > 200_000:
                    memory.clear()
                got = memory[word] = tuple(u for u in units(word) if u in known)
            return got

        def score(texts: list[bytes]) -> np.ndarray:
            found = []
            for text in texts:
                words = alnum_words(text)
                counts: Counter = Counter()
                for us in filter(None, map(wanted, words)):
                    counts.update(us)
                total = len(words)
                found.append([(u, k) for u, n in counts.items() for k, least in enumerate(LEVELS) if n >= least * total])
            out = np.zeros((len(texts), len(self.categories)))
            for c, (column, w) in enumerate(zip(columns, self.weights)):
                z = out[:, :c] @ w[len(column):len(column) + c] + w[-1]
                for i, fs in enumerate(found):
                    z[i] += sum(w[column[f]] for f in fs if f in column)
                out[:, c] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return out

        return score


def _g2(with_pos, with_all, pos, total):
    """Likelihood ratio of a feature's 2x2 table against independence, as a column."""
    a, b = with_pos, with_all - with_pos
    c, d = pos - with_pos, total - pos - with_all + with_pos

    def part(n, row, col):
        return F.when(n > 0, n * F.log(n * total / (row * col))).otherwise(F.lit(0.0))

    return 2 * (part(a, with_all, pos) + part(b, with_all, total - pos)
                + part(c, total - with_all, pos) + part(d, total - with_all, total - pos))


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], sample_rows: int = 6000, folds: int = 4,
        features: int = 300, least_docs: int = 8) -> Chain:
    """Fit a chain on ``labels`` (doc_id and a 0/1 column per category, null: not labelled).

    At most ``sample_rows`` labelled doc_ids, those with the least hash, are fitted,
    each with one text: of a doc_id that is there several times the one with the
    least hash.  That bounds what is fitted, and what reaches the driver.  Rows with
    a null doc_id are left out; labels given twice count as 1 if any is; a category without both classes gets a constant model near 0 or 1.
    """
    spark = docs.sparkSession
    own = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
           .agg(*[F.max(F.col(c)).cast("double").alias(f"y{i}") for i, c in enumerate(categories)]))
    sample = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                  .join(F.broadcast(sample), "doc_id")  # at most sample_rows rows of numbers
                  # a doc_id's rows count as one document: the text with the least hash
                  .groupBy(*sample.columns).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
                  .select("doc_id", "text", *sample.columns[1:])
                  .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(folds)).cast("int"))
                  .drop("doc_id").repartition(max(2, spark.sparkContext.defaultParallelism)), "toxicity-sample")
    ys = [f"y{i}" for i in range(len(categories))]
    totals = rows.groupBy("fold").agg(*[F.sum(y).alias(f"{y}_pos") for y in ys], *[F.count(y).alias(y) for y in ys]).collect()

    def counted(batches):
        names = ["unit", "level", "fold"] + [x for y in ys for x in (f"{y}_pos", y)]
        types = [pa.binary(), pa.int32(), pa.int32()] + [pa.float64()] * (2 * len(ys))
        n: dict = {}

        def told():
            keys, sums_ = list(n), list(n.values())
            n.clear()
            for at in range(0, len(keys), 10_000):
                columns = [*zip(*keys[at:at + 10_000]), *zip(*sums_[at:at + 10_000])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch, texts in text_slices(batches, 0):
            folds_, own_ys = batch.column("fold").to_pylist(), [batch.column(y).to_pylist() for y in ys]
            for i, text in enumerate(texts):
                y = [c[i] for c in own_ys]
                for unit, level in document_features(alnum_words(text)):
                    own_n = n.setdefault((unit, level, folds_[i]), [0.0] * (2 * len(ys)))
                    for k, v in enumerate(y):
                        if v is not None:
                            own_n[2 * k] += v
                            own_n[2 * k + 1] += 1
                if len(n) > _COUNTED:  # the sums go on behind the shuffle
                    yield from told()
        if n:
            yield from told()

    schema = "unit binary, level int, fold int, " + ", ".join(f"{y}_pos double, {y} double" for y in ys)
    counts = map_arrow(rows, counted, schema)
    # per feature: its counts in all, and in each fold by itself
    sums = [F.sum(x).alias(x) for y in ys for x in (f"{y}_pos", y)]
    per = [F.sum(F.when(F.col("fold") == f, F.col(x)).otherwise(0.0)).alias(f"{x}_{f}")
           for f in range(folds) for y in ys for x in (f"{y}_pos", y)]
    by_feature = staged(counts.groupBy("unit", "level").agg(*sums, *per)
                        .where(F.greatest(*map(F.col, ys), F.lit(0.0)) >= least_docs), "toxicity-features")
    chosen: dict[tuple[int, int], list] = {}
    for k, y in enumerate(ys):
        for f in range(-1, folds):  # -1: the final model; else the model that leaves fold f out
            others = [t for t in totals if t["fold"] != f]
            pos, total = (float(sum((t[c] or 0) for t in others)) for c in (f"{y}_pos", y))
            less = lambda c: F.col(c) - F.col(f"{c}_{f}") if f >= 0 else F.col(c)
            g2 = _g2(less(f"{y}_pos"), less(y), F.lit(pos), F.lit(total))
            chosen[k, f] = [(bytes(r[0]), r[1]) for r in by_feature.where(less(y) >= least_docs).select("unit", "level", g2.alias("g"))
                            .orderBy(F.desc("g"), "unit", "level").limit(features).collect()] if 0 < pos < total else []

    wanted = {f for fs in chosen.values() for f in fs}
    wanted_units = {u for u, _ in wanted}
    number = {f: i for i, f in enumerate(sorted(wanted))}

    def matrix(batches):
        for batch, texts in text_slices(batches, 0):
            at = []
            for text in texts:
                own_fs = document_features(alnum_words(text), lambda w: [u for u in units(w) if u in wanted_units])
                at.append(sorted(number[f] for f in own_fs if f in number))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.list_(pa.int32())), batch.column("fold"),
                                              *[batch.column(y) for y in ys]], names=["at", "fold", *ys])

    got = map_arrow(rows, matrix, "at array<int>, fold int, " + ", ".join(f"{y} double" for y in ys)).collect()
    x = np.zeros((len(got), len(number)))
    for i, r in enumerate(got):
        x[i, r["at"]] = 1
    fold = np.array([r["fold"] for r in got], dtype=int)
    chain, earlier = Chain(list(categories)), np.zeros((len(got), 0))
    for k, y in enumerate(ys):
        label = np.array([np.nan if r[y] is None else r[y] for r in got])
        known = ~np.isnan(label)
        out = np.zeros(len(got))
        for f in range(folds):
            own_x = np.hstack([x[:, [number[u] for u in chosen[k, f]]], earlier])
            out[fold == f] = predict(fit_logistic(own_x[known & (fold != f)], label[known & (fold != f)]), own_x[fold == f])
        own_x = np.hstack([x[:, [number[u] for u in chosen[k, -1]]], earlier])
        chain.features.append(chosen[k, -1])
        chain.weights.append(fit_logistic(own_x[known], label[known]))
        chain.thresholds.append(best_threshold(out[known], label[known]))
        chain.held_out.append((out[known], label[known]))
        earlier = np.hstack([earlier, out[:, None]])
    return chain


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold with the best F0.5 (precision counts more: clean documents are
    to stay) on out-of-fold probabilities, in the middle between two of them, 0.2
    at least (0.5 where nothing is known)."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    if not len(y) or not y.sum():
        return 0.5
    hits = np.cumsum(y)
    f = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    f[:-1][p[:-1] == p[1:]] = 0  # rows of one probability stand or fall together
    best = int(np.argmax(f))
    return max(0.2, float(p[best] + (p[best + 1] if best + 1 < len(p) else 0)) / 2)


def scores(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, one probability column ``p_<category>`` and one decision
    ``<category>`` per category.  Null and empty texts have no words and get the
    models' constants; repeated rows get a row each; other columns are not read; an
    empty table gives no rows.  A very long text is scored whole, in one task."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # a few hundred weights
    names = ["doc_id"] + [f"p_{c}" for c in chain.categories] + list(chain.categories)

    def run(batches: Iterator[pa.RecordBatch]):
        score = shared.value.scorer()
        for batch, texts in text_slices(batches, 1):
            p = score(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, p.T), *[pa.array(p[:, c] >= t) for c, t in enumerate(chain.thresholds)]],
                names=names)

    schema = "doc_id long, " + ", ".join(f"`p_{c}` double" for c in chain.categories) + ", " + ", ".join(
        f"`{c}` boolean" for c in chain.categories)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(own, run, schema)


def without(docs: DataFrame, chain: Chain, category: str) -> DataFrame:
    """``docs`` without those the chain puts into ``category``; all columns stay.
    Null and empty texts have no words and get the model's constant; repeated rows
    stand or fall together; an empty table stays empty; a very long text is scored
    whole, in one task."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at, c = docs.columns.index("text"), chain.categories.index(category)

    def run(batches):
        score = shared.value.scorer()
        for batch, texts in text_slices(batches, at):
            p = score(texts)
            yield batch.filter(pa.array(p[:, c] < shared.value.thresholds[c], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
