"""Runs of periodic words: stretches that repeat themselves at least four times.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 4 * q)`` words long, that no neighbouring word extends.  Candidates
come from harmonic grids: a run of period p and 4p words or more covers four
neighbouring multiples of p, at which the words must be equal, so for every p only
each p-th word is looked at (n/1 + n/2 + ... of them).  How far a candidate really
reaches to both sides is asked of a run-length grammar that recompression makes
of the texts that have candidates (see ``recompression``).  A stretch found with a
multiple of its period has the same ends as with the period itself, so the
smallest period of equal ends is the run's.

Neighbouring grid points of one p make a stretch of candidates; the first one's
extension mostly explains the others, and where it doesn't, twice as many are asked
in the next go.

Scale: one pass without a shuffle; a task holds a slice of about a megabyte of
texts, or one long text, with about 150 bytes a word of it.  Words are compared
as they are, not by hash.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_slices
from .recompression import Grammar

REPEATS = 4


def _stretches(symbols: np.ndarray, ends: np.ndarray, lengths: np.ndarray, least: int) -> np.ndarray:
    """p, first and last multiplier of each stretch of candidates: multiples of p
    with the same word there and at the next three.  Texts stand one behind the
    other, the longest first, and end at ``ends`` with a symbol of their own."""
    out = []
    for p in range(1, int(lengths[0]) // REPEATS + 1):
        n_texts = int(np.searchsorted(-lengths, -max(least, REPEATS * p), "right"))
        if not n_texts:
            break
        grid = symbols[:ends[n_texts - 1]:p]
        same = grid[1:] == grid[:-1]
        found = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(found):
            cut = np.flatnonzero(np.diff(found) > 1)
            first, last = found[np.concatenate([[0], cut + 1])], found[np.append(cut, len(found) - 1)]
            out.append(np.stack([np.full(len(first), p), first, last], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


def _extended(stretches: np.ndarray, place: np.ndarray, grammar: Grammar, least: int) -> np.ndarray:
    """start, end, period of what the candidates belong to, where long enough;
    ``place`` gives the position in the grammar's words."""
    found, step = [], 1
    p, at, last = stretches.T.copy()
    while len(p):
        many = np.minimum(step, last - at + 1)
        own = np.repeat(np.arange(len(p)), many)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        period = p[own]
        here = place[(at[own] + nth) * period]
        there = place[(at[own] + nth + 1) * period]
        apart = there - here == period  # else a text's end lies between
        start, end = here.copy(), here + period
        start[apart] -= grammar.common(here[apart] - 1, there[apart] - 1, back=True)
        end[apart] += grammar.common(here[apart], there[apart])
        good = end - start >= np.maximum(least, REPEATS * period)
        found.append(np.stack([start[good], end[good], period[good]], axis=1))
        # a candidate whose four places lie in a run is explained by it
        beyond = np.where(good, -(-(end - here) // period) - (REPEATS - 1), 1)
        np.maximum.at(at, own, at[own] + nth + np.maximum(1, beyond))
        more = at <= last
        p, at, last = p[more], at[more], last[more]
        step *= 2
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


def runs_of(texts: list[list[bytes]], least: int = 6) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text's words, in this order."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, words in enumerate(texts) if len(words) >= least), key=lambda i: -len(texts[i]))
    if not order:
        return out
    names: dict[bytes, int] = {}
    ids = [np.fromiter((names.setdefault(w, len(names)) for w in texts[i]), dtype=np.int64, count=len(texts[i])) for i in order]
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    closed = [part for k, x in enumerate(ids) for part in (x, [len(names) + k])]
    symbols = np.concatenate(closed)
    ends = np.cumsum(lengths + 1)
    stretches = _stretches(symbols, ends, lengths, least)
    if not len(stretches):
        return out
    # the grammar is made of the texts that candidates touch
    touched = np.zeros(len(ids) + 1, dtype=np.int64)
    p, first, last = stretches.T
    np.add.at(touched, np.searchsorted(ends, first * p, "right"), 1)
    np.add.at(touched, np.searchsorted(ends, (last + REPEATS - 1) * p, "right") + 1, -1)
    wanted = np.repeat(np.cumsum(touched[:-1]) > 0, lengths + 1)
    place = np.cumsum(wanted) - 1
    back = np.flatnonzero(wanted)
    found = _extended(stretches, place, Grammar(symbols[wanted]), least)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    found = found[np.concatenate([[True], (found[1:, :2] != found[:-1, :2]).any(axis=1)])] if len(found) else found
    start = back[found[:, 0]]
    text = np.searchsorted(ends, start, "right")
    begin = (ends - lengths - 1)[text]
    for t, s, n, q in zip(text.tolist(), (start - begin).tolist(), (found[:, 1] - found[:, 0]).tolist(), found[:, 2].tolist()):
        out[order[t]].append((s, n, q))
    return [sorted(x) for x in out]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """``words`` without those that any run has after its first period."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return list(itertools.compress(words, (np.cumsum(edges)[:-1] == 0).tolist()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6) -> DataFrame:
    """``id_col``, n_words, runs (array of start, length, period, all longs, in this
    order) and collapsed (the words that are left, joined by one blank) per row.

    Words are what stands between blanks and ASCII tabs, line ends and feeds, as
    they are.  A null, empty or blank text has no words, no runs and an empty
    collapsed text; repeated rows give repeated results, a null id stays null, an
    empty table gives no rows.  Other columns, of whatever name, are not looked at.
    A very long text is one task's work, about n log n for its n words.
    """
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, 1):
            words = [t.split() for t in texts]
            found = runs_of(words, least)
            told = [[{"start": s, "length": n, "period": q} for s, n, q in x] for x in found]
            left = [b" ".join(collapsed(w, x)) for w, x in zip(words, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(told, run), pa.array(left, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_arrow(own, work, schema).withColumnRenamed("id", id_col)
