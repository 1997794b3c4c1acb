"""Benchmark decontamination by a broadcast set of test n-grams.

Windows of ``n`` consecutive words of the benchmark items (an item of fewer
words is one window) are hashed into sorted arrays and broadcast; every
document is scanned as word numbers of the benchmark's own vocabulary, so only
runs of words the benchmark knows are hashed at all; hash hits are verified
word by word.

The broadcast is bounded by ``block_chars``: repeated items count once, a longer
item is cut into pieces that share n - 1 words, and a larger benchmark is dealt to
blocks by a hash of the pieces; a block is larger by a sixteenth or 4 KB at most, as
far as the hash is even.  The documents are scanned once per block, and the blocks' hits of a document are put together by a shuffle.
A full block of 16 MB (2.4 million windows) took 7 seconds and 270 MB on the driver
and 86 MB in each worker.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, map_arrow, row_key, staged, text_slices

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCKS_A_PASS = 4   # of a benchmark in blocks, which Python workers of one task hold together
_LEAST_PIECE = 4096  # characters; shorter items are not cut
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class WindowSet:
    """The windows of a block of items, by their number of words: a hash, a place in
    the items' words and the ids of the items, all as arrays."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        parts, sizes = [], []
        for _, text in items:
            words = alnum_words((text or "").encode())
            parts.append(np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words), dtype=np.uint32, count=len(words)))
            sizes.append(len(words))
        self.words = np.concatenate([*parts, np.zeros(0, dtype=np.uint32)])
        sizes = np.array(sizes, dtype=np.int64)
        ids = np.array([0 if i is None else i for i, _ in items], dtype=np.int64)
        named = np.array([i is not None for i, _ in items], dtype=bool)
        begin = np.cumsum(sizes) - sizes
        self.by_size = {}
        for size in np.unique(np.minimum(n, sizes[sizes > 0])).tolist():
            own = np.flatnonzero(np.minimum(n, sizes) == size)
            count = sizes[own] - size + 1
            item = np.repeat(own, count)
            starts = np.repeat(begin[own] - (np.cumsum(count) - count), count) + np.arange(len(item))
            hashes = self.hashes(self.words, starts, size)
            order = np.argsort(hashes, kind="stable")
            same = self._alike(starts[order], size)
            if (~same & (hashes[order][1:] == hashes[order][:-1])).any():  # different windows of one hash: by words, too
                order = np.lexsort([*(self.words[starts + k] for k in range(size)), hashes])
                same = self._alike(starts[order], size)
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            group = np.cumsum(np.concatenate([[True], ~same])) - 1
            # the distinct items of each window
            group, item = group[named[item[order]]], ids[item[order]][named[item[order]]]
            by = np.lexsort((item, group))
            group, item = group[by], item[by]
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (item[1:] != item[:-1])])[:len(group)]
            group, item = group[new], item[new]
            self.by_size[size] = (hashes[order][first], starts[order][first], np.searchsorted(group, np.arange(len(first) + 1)), item)

    def _alike(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Whether each window is the same as the one before it, from the second on."""
        same = np.ones(max(0, len(starts) - 1), dtype=bool)
        for k in range(size):
            same &= self.words[starts[1:] + k] == self.words[starts[:-1] + k]
        return same

    @staticmethod
    def hashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        h = np.zeros(len(starts), dtype=np.uint64)
        for k in range(size):
            h = (h ^ words[starts + k].astype(np.uint64)) * _MIX
            h ^= h >> np.uint64(29)
        return h

    def scan(self, texts: list[bytes]) -> tuple[list[int], dict[int, tuple[list[tuple[int, int]], set]]]:
        """Number of words of each text, and by text number its hit spans
        (first word, end; overlapping ones joined) and items."""
        get = self.vocabulary.get
        counts, flat = [], []
        for text in texts:
            words = alnum_words(text)
            counts.append(len(words))
            flat.extend([get(w, 0) for w in words])
            flat.append(0)  # no window crosses from one text to the next
        ids = np.array(flat, dtype=np.uint32)
        first = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64) + 1)])
        gaps = np.concatenate([[-1], np.flatnonzero(ids == 0)])
        run_at, run_len = gaps[:-1] + 1, np.diff(gaps) - 1
        found: dict[int, tuple[list[tuple[int, int]], set]] = {}
        places = []
        for size, (hashes, windows, owner_at, owners) in self.by_size.items():
            long_enough = run_len >= size
            at, count = run_at[long_enough], run_len[long_enough] - size + 1
            if not len(at):
                continue
            starts = np.repeat(at - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            own = self.hashes(ids, starts, size)
            slot = np.searchsorted(hashes, own)
            while len(starts):  # the windows of one hash, one after the other
                near = slot < len(hashes)
                near[near] = hashes[slot[near]] == own[near]
                starts, own, slot = starts[near], own[near], slot[near]
                same = np.ones(len(starts), dtype=bool)
                for k in range(size):
                    same &= ids[starts + k] == self.words[windows[slot] + k]
                places += [(start, start + size, owners[owner_at[k]:owner_at[k + 1]].tolist()) for start, k in zip(starts[same].tolist(), slot[same].tolist())]
                starts, own, slot = starts[~same], own[~same], slot[~same] + 1
        places.sort(key=lambda x: x[:2])
        for start, end, items in places:
            doc = int(np.searchsorted(first, start, side="right")) - 1
            start, end = start - int(first[doc]), end - int(first[doc])
            spans, known = found.setdefault(doc, ([], set()))
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((start, end))
            known.update(items)
        return counts, found


def _pieces(benchmark: DataFrame, n: int, most_chars: int) -> DataFrame:
    """item_id and text of the distinct items; an item of more than ``most_chars``
    characters as several, of which neighbours share n - 1 words: the same windows."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()

    def cut_long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, 1):
            ids, out = [], []
            for item_id, text in zip(batch.column(0).to_pylist(), texts):
                words = alnum_words(text)
                at = 0
                while at < len(words) and (at == 0 or at + n - 1 < len(words)):
                    end, size = at, 0
                    while end < len(words) and (size < most_chars or end < at + n):
                        size += len(words[end]) + 1
                        end += 1
                    ids.append(item_id)
                    out.append(b" ".join(words[at:end]))
                    at = max(at + 1, end - n + 1) if end < len(words) else len(words)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], names=["item_id", "text"])

    return staged(map_arrow(items, cut_long, "item_id long, text string").distinct(), "benchmark-pieces")


def _blocks(benchmark: DataFrame, n: int, block_chars: int) -> Iterator[WindowSet]:
    """The benchmark in blocks of about ``block_chars`` characters, one on the driver at a time.

    Pieces are dealt to bins by hash, 16 for a block's worth of text; neighbouring
    bins make a block as long as they fit in it."""
    pieces = _pieces(benchmark, n, max(block_chars // 16, _LEAST_PIECE))
    size = F.sum(F.octet_length("text") + 1)
    bins = max(1, 16 * int(pieces.agg(size).first()[0] or 0) // block_chars)
    dealt = pieces.withColumn("bin", F.pmod(F.xxhash64("item_id", "text"), F.lit(bins)))
    sizes = {r["bin"]: r["size"] for r in dealt.groupBy("bin").agg(size.alias("size")).collect()}  # 16 rows a block
    first, held = 0, 0
    for b in range(bins + 1):
        if b == bins or held and held + sizes.get(b, 0) > block_chars:
            own = dealt.where((F.col("bin") >= first) & (F.col("bin") < b)).select("item_id", "text")
            yield WindowSet([tuple(r) for r in own.collect()], n)
            first, held = b, 0
        held += sizes.get(b, 0)


_HIT_SCHEMA = "n_words long, spans array<struct<first:long,end:long>>, items array<long>"
_HIT_TYPES = [pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64())]


def _scan(docs: DataFrame, windows: WindowSet, column: str) -> DataFrame:
    """``docs`` with a struct ``column`` of n_words, spans and items."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    names, at = [*docs.columns, column], docs.columns.index("text")
    kind = pa.struct([(f, t) for f, t in zip(("n_words", "spans", "items"), _HIT_TYPES)])

    def run(batches):
        for batch, texts in text_slices(batches, at):
            counts, found = shared.value.scan(texts)
            hits = []
            for k, n_words in enumerate(counts):
                spans, items = found.get(k, ([], ()))
                hits.append({"n_words": n_words, "spans": [{"first": a, "end": b} for a, b in spans],
                             "items": sorted(items)})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, kind)], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_arrow(docs, run, f"{schema}, `{column}` struct<{_HIT_SCHEMA}>")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_chars: int = 16 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, spans (word ranges inside an
    occurrence of a window, disjoint, ascending) and items (sorted distinct
    ids of the items with such windows).

    Null and empty texts have no words; an item without words has no window;
    an item without an id marks words but is not listed; repeated rows get
    each their own row; other columns are not read; an empty table gives no rows.
    A very long text is scanned whole, in one task.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    parts = [_scan(own, w, "hit").select("doc_id", row_key("doc_id", "text").alias("key"), "hit.*")
             for w in _blocks(benchmark, n, block_chars)]
    if len(parts) == 1:
        return parts[0].drop("key")
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    # each block gives every row of a document; rows alike stay as many as they were
    together = both.groupBy("doc_id", "key").agg(
        F.first("n_words").alias("n_words"), (F.count(F.lit(1)) / F.lit(len(parts))).cast("int").alias("rows"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    joined = F.aggregate(
        "s", F.expr("cast(array() as array<struct<first:bigint,end:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (x["first"] <= F.element_at(acc, -1)["end"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1)["first"].alias("first"),
                                  F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    return (together.withColumn("spans", F.when(F.size("s") > 0, joined).otherwise(F.col("s")))
            .withColumn("_", F.explode(F.sequence(F.lit(1), "rows")))
            .select("doc_id", "n_words", "spans", "items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "document",
                  block_chars: int = 16 << 20) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="span"``) with the
    hit words and what stands between them cut out of their texts.

    All columns stay, clean documents stay as they are.  Null and empty texts have
    no words and are clean; repeated rows stand or fall together; without a
    benchmark, or with items without words, all documents stay; an empty table
    stays empty.  A very long text is scanned whole, in one task.
    """
    if remove not in ("document", "span"):
        raise ValueError("remove must be 'document' or 'span'")
    out = docs
    at = docs.columns.index("text")
    for number, windows in enumerate(_blocks(benchmark, n, block_chars)):
        shared = docs.sparkSession.sparkContext.broadcast(windows)

        def run(batches, shared=shared):
            for batch, texts in text_slices(batches, at):
                _, found = shared.value.scan(texts)
                if remove == "document":
                    yield batch.filter(pa.array([k not in found for k in range(len(texts))], pa.bool_()))
                else:
                    column = batch.column(at)
                    if found:
                        column = pa.array([cut(t, found[k][0]) if k in found else x for k, (t, x) in
                                           enumerate(zip(texts, column.to_pylist()))], column.type)
                    yield pa.RecordBatch.from_arrays([column if k == at else c for k, c in enumerate(batch.columns)],
                                                     names=batch.schema.names)

        out = map_arrow(out, run, docs.schema)
        if number % _BLOCKS_A_PASS == _BLOCKS_A_PASS - 1:
            out = staged(out, "decontaminated")
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans``."""
    words = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at:words[first][0]])
        at = words[end - 1][1]
    return b"".join([*kept, text[at:]]).decode()


def items_digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
