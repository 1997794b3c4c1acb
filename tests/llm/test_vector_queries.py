"""Exact top-k search and hard-negative mining against brute force."""
import math

import numpy as np
import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from pathfold.llm import hard_negatives, queries, va_file
from pathfold.llm.hard_negatives import Summaries, score_bounds, summaries

DDL = "vec_id long, embedding array<double>, label int, id string, row string, block string, n string, score string, qblock string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, *"clash!"[:6]) for i, v, label in rows], DDL)


def usable(rows, scale, labelled=False):
    return [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and not (labelled and label is None)]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_topk(rows, k, scale, is_query):
    own = usable(rows, scale)
    out = []
    for q in sorted({i for i, *_ in own if is_query(i)}):
        x = min(v for i, v, _ in own if i == q)
        best = sorted((-dot(x, v), i) for i, v, _ in own if i != q and len(v) == len(x))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def brute_mining(rows, scale, is_anchor, n_positives=5, n_negatives=3):
    own = usable(rows, scale, labelled=True)
    out = []
    for a in sorted({i for i, *_ in own if is_anchor(i)}):
        label, x = min((label, v) for i, v, label in own if i == a)
        met = [(-dot(x, v), i, other) for i, v, other in own if len(v) == len(x)]
        positives = sorted((s, i) for s, i, other in met if other == label and i != a)[:n_positives]
        for ps, p in positives:
            negatives = sorted((s, i) for s, i, other in met if other != label and 50 * -ps <= 100 * -s <= 95 * -ps)[:n_negatives]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(negatives)]
    return sorted(out)


def random_rows(n, d, seed, spread=1.0, ties=False):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, d))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 5))
        v = centres[label] + spread * rng.standard_normal(d)
        rows.append((i, [float(x) for x in (np.round(v) if ties else v)], label))
    return rows


ODD = [(1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [float("inf")] + [0.0] * 7, 2), (None, [1.0] * 8, 1),
       (1004, [0.0] * 8, 3), (1005, [1.0] * 8, None), (1006, [], 1), (1008, [], 1), (1010, [1.0, 2.0], 0), (1020, [2.0, 1.0], 1),
       (1040, [2.0, 1.5], 0), (20, [0.5] * 8, 1), (20, [0.5] * 8, 1), (21, [0.5] * 8, 2), (21, [0.5] * 8, 2)]


@pytest.mark.parametrize("bits,block_rows,query_rows", [(5, 8192, 1024), (1, 40, 3), (8, 100, 10)])
@pytest.mark.parametrize("ties", [False, True])
def test_topk_against_brute_force(spark, bits, block_rows, query_rows, ties):
    rows = random_rows(250, 8, 3, ties=ties) + ODD
    found = va_file.search(table(spark, rows), F.col("id") % 20 == 0, 7, 16, bits=bits, block_rows=block_rows, query_rows=query_rows)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(brute_topk(rows, 7, 16, lambda i: i % 20 == 0))


def test_topk_fewer_than_k_none_and_huge(spark):
    few = random_rows(5, 4, 1)
    assert sorted(map(tuple, va_file.search(table(spark, few), F.col("id") == 0).collect())) == brute_topk(few, 20, 64, lambda i: i == 0)
    assert va_file.search(table(spark, []), F.col("id") == 0).count() == 0
    assert va_file.search(table(spark, few), F.col("id") == 77).count() == 0
    huge = [(0, [3e9, 1e9], 0), (1, [4e9, 1.0], 0), (2, [1e200, 1.0], 0), (3, [1.0, 1.0], 0), (4, [1e308, 0.0], 0)]
    got = {r.vec_id: r.score for r in va_file.search(table(spark, huge), F.col("id") == 0, scale=2).collect()}
    assert got == {1: min((1 << 63) - 1, 6_000_000_000 * 8_000_000_000 + 2_000_000_000 * 2), 2: (1 << 63) - 1, 3: 16_000_000_000}


def test_cells_bound_every_score():
    rng = np.random.default_rng(5)
    vectors, queries_ = np.floor(rng.standard_normal((500, 16)) * 20), np.floor(rng.standard_normal((30, 16)) * 20)
    vectors[:200, 3] = 7
    exact = queries_ @ vectors.T
    for bits in (1, 3, 5):
        file = va_file.quantise(vectors, bits)
        upper, lower = (va_file.bounds(queries_, *file, up) for up in (True, False))
        assert (lower <= exact).all() and (exact <= upper).all()


def test_exact_vectors_are_read_in_order_until_certain():
    """On vectors with structure a small part is read."""
    rng = np.random.default_rng(5)
    vectors = np.floor(64 * (rng.standard_normal((4, 32))[rng.integers(0, 4, 4000)] + 0.3 * rng.standard_normal((4000, 32))))
    upper = va_file.bounds(vectors[:20], *va_file.quantise(vectors, 5), True)
    for q, most in zip(vectors[:20], upper):
        rows, scores, read = va_file.read_in_order(vectors, np.arange(4000), q, most, np.arange(4000), 20)
        exact = (vectors @ q).astype(np.int64)
        assert scores.tolist() == sorted(exact.tolist(), reverse=True)[:20] and read < 1000


def test_summaries_bound_scores_and_finer_ones_are_closer():
    rng = np.random.default_rng(5)
    vectors = np.floor(256 * rng.standard_normal((300, 24)))
    widths = []
    for m in (1, 2, 3, 8, 24):
        means, deviations = summaries(vectors, m)
        low, high = score_bounds(means, deviations, means[0], deviations[0], 1e-3)
        exact = vectors @ vectors[0]
        assert (low <= exact).all() and (exact <= high).all()
        widths.append(float((high - low).mean()))
    assert widths == sorted(widths, reverse=True) and widths[-1] < 1e-1


def test_segments_rule_rows_out(spark):
    """Where segments are alike inside, few rows are scored exactly."""
    rng = np.random.default_rng(2)
    vectors = np.floor(np.repeat(rng.standard_normal((3000, 8)), 8, axis=1) * 100 + rng.standard_normal((3000, 64)))
    levels = (1, 4, 8)
    block = {"n": 3000, "dim": 64, "exact": vectors.tobytes(), "ids": np.arange(3000).tobytes(), "labels": np.zeros(3000, dtype="<i8").tobytes()}
    for m in levels:
        means, deviations = summaries(vectors, m)
        block |= {f"mean{m}": means.tobytes(), f"dev{m}": deviations.tobytes()}
    there = Summaries(block, levels)
    (rows, scores), = there.left(there, slice(0, 1), [np.arange(3000)], [np.array([[-np.inf, np.inf]])], 5)
    assert there.scored < 300
    assert sorted(scores.tolist(), reverse=True)[:5] == sorted((vectors @ vectors[0]).astype(int).tolist(), reverse=True)[:5]


@pytest.mark.parametrize("levels,block_rows,anchor_rows", [((1, 4, 16, 32), 8192, 512), ((2, 8), 50, 2), ((), 64, 512)])
@pytest.mark.parametrize("ties,spread", [(False, 1.0), (True, 1.0), (True, 0.3)])
def test_mining_against_brute_force(spark, levels, block_rows, anchor_rows, ties, spread):
    rows = random_rows(300, 8, 4, spread, ties) + ODD
    found = hard_negatives.mine(table(spark, rows), F.col("id") % 20 == 0, scale=16, levels=levels, block_rows=block_rows, anchor_rows=anchor_rows)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_mining(rows, 16, lambda i: i % 20 == 0)
    assert sorted(map(tuple, found.collect())) == want and want


def test_mining_nothing(spark):
    for rows in ([], random_rows(3, 4, 1), [(0, [1.0], None), (50, [1.0], 1)]):
        assert hard_negatives.mine(table(spark, rows), F.col("id") == 0).count() == len(brute_mining(rows, 256, lambda i: i == 0))


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_va_file_topk"])
def test_query_against_sql(spark, sf, name):
    ok, why = compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], sf, duck(sf))
    assert ok, why
