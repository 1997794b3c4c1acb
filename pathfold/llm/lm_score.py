"""Language-model scores from a sharded Elias-Fano n-gram trie.

The model is an order-3 hierarchical Dirichlet model over words, learned from
the training documents and scored on all:

    p1(w)      = (c(w) + 1/2) / (N + (V + 1) / 2)
    p2(w|v)    = (c(vw) + k(v) p1(w)) / (c(v) + k(v)),   k(v) = 2 c(v)^0.9 + 1
    p3(w|u,v)  = (c(uvw) + 20 p2(w|v)) / (c(uv) + 20)

Its trie is sharded by the bigram (v, w): a shard has the words, the bigrams and
under each the words u before it, as Elias-Fano levels (``elias_fano``) with the
smoothed log probabilities in 16-bit codes.  The factor 1 / (c(uv) + 20) of a
token belongs to the bigram (u, v), that is, to the shard of the token before,
so a shard answers for every occurrence of its bigrams without asking another.

Steps, each linear in the number of tokens:

1. Documents are read once, in blocks of about ``block_tokens`` tokens: the
   block's distinct words, their counts in training, and the tokens as numbers
   of these words.
2. Word counts are summed up by word, sharded, and go back to the blocks.
3. Every block sends the occurrences of a bigram with the counts of its words
   to the bigram's shard, where the trie is built and asked.
4. The shards' sums per document meet at the block.

Skew: a frequent word is one row per block in step 2.  A bigram with more than
1/1024 of all tokens (at most 1024 such) is spread over the shards by the word
before it, its total counted beforehand.
"""
from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASH_BASE, map_arrow, mix64, runs, staged, text_slices, word_hashes
from .elias_fano import Level, Monotone, image, opened

END, BEGIN = np.uint64(0), np.uint64(1)  # in place of words' hashes
BEGIN_NUMBER = 1 << 40  # in place of a word's number in the vocabulary
MU = 20.0
STEP = 1 / 256  # of the 16-bit codes, in log10
HOT_SHARE = 1024


def spread(count: np.ndarray) -> np.ndarray:
    return 2 * count ** 0.9 + 1


def codes(log_p: np.ndarray) -> np.ndarray:
    """log10 values of -64 to 192 as 16-bit codes."""
    return np.clip(np.rint((log_p + 64) / STEP), 0, 65535).astype(np.uint16)


def values(code: np.ndarray) -> np.ndarray:
    return code * STEP - 64


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed blob, each as planes of its bytes."""
    head, planes = [], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append((a.dtype.str, len(a)))
        planes.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    raw = b"".join([json.dumps(head).encode(), b"\n", *planes])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def unpacked(blob: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    at = raw.index(b"\n") + 1
    out = []
    for kind, n in json.loads(raw[:at]):
        kind = np.dtype(kind)
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * kind.itemsize, offset=at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _rows(names, types, rows):
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)] if rows
                                      else [pa.array([], t) for t in types], names=names)


# --- step 1: blocks ---------------------------------------------------------------------------------------------------

def _blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """block, tokens (their number), base (of documents: id, has id, held out,
    tokens; of tokens: rank of the word), ranks (of the words by frequency, as
    the words are sorted), words (steps between the sorted hashes, and counts
    in training), pairs (hashes of the bigrams with more than 1/1024 of the
    block's tokens)."""
    names = ["block", "tokens", "base", "ranks", "words", "pairs"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        ids, held, counts, hashes, total = [], [], [], [], 0

        def flush():
            nonlocal made, ids, held, counts, hashes, total
            tokens = np.concatenate(hashes)
            words, number = np.unique(tokens, return_inverse=True)
            n, out = np.array(counts, dtype=np.int64), np.array(held, dtype=bool)
            every = np.bincount(number, minlength=len(words))
            train = np.bincount(number[np.repeat(~out, n)], minlength=len(words))
            rank = np.empty(len(words), dtype=np.int64)  # frequent words get small numbers
            rank[np.argsort(-every, kind="stable")] = np.arange(len(words))
            base = [np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids]), out, n, _narrow(rank[number])]
            row = (task << 32 | made, total, packed(*base), packed(_narrow(rank)), packed(np.diff(words, prepend=np.uint64(0)), _narrow(train)),
                   _frequent(tokens, n).view(np.int64).tolist())
            made += 1
            ids, held, counts, hashes, total = [], [], [], [], 0
            return _rows(names, types, [row])

        for part, texts in text_slices(batches, 2):
            words, first = word_hashes(texts)
            # words beside the two marks, an end after each text
            tokens = np.insert(np.where(words <= BEGIN, words + np.uint64(2), words), first[1:], END)
            hashes.append(tokens)
            ids += part.column(0).to_pylist()
            held += part.column(1).to_pylist()
            counts += (np.diff(first) + 1).tolist()
            total += len(tokens)
            if total >= block_tokens:
                yield flush()
        if ids:
            yield flush()

    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("held_out"), F.lit(False)), F.col("text").cast("string"))
    return map_arrow(own, run, "block long, tokens long, base binary, ranks binary, words binary, pairs array<long>")


def _before(tokens: np.ndarray, n: np.ndarray, mark) -> np.ndarray:
    """The token before each, or ``mark`` at a document's first (``n``: tokens per document)."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[np.concatenate([[0], np.cumsum(n)[:-1]])] = mark
    return out


def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(v * HASH_BASE + w)


def _frequent(tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hashes of the bigrams with more than 1/1024 of the tokens."""
    pair = _pair(_before(tokens, n, BEGIN), tokens)
    slot = (pair & np.uint64(0xFFFF)).astype(np.int64)
    crowded = np.bincount(slot, minlength=1 << 16) * HOT_SHARE > len(pair)  # only there can one be
    known, times = np.unique(pair[crowded[slot]], return_counts=True)
    return known[times * HOT_SHARE > len(pair)]


# --- step 2: word counts ----------------------------------------------------------------------------------------------

def _word_counts(blocks: DataFrame, shards: int, wanted: set[int]) -> DataFrame:
    """block, shard, blob: number and count of each of the block's words in the
    shard; rows without block with how many words the shard has (words), how
    many of them are known (v), and their tokens (n); and rows with the number
    (n) that each of the ``wanted`` hashes (word) has in the shard."""
    top = np.array([(i << 64) // shards for i in range(1, shards)], dtype=np.uint64)
    ask_for = np.array(sorted(wanted), dtype=np.uint64)
    names = ["block", "shard", "blob", "words", "v", "n", "word"]
    types = [pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 4]

    def ask(batches):
        for batch in batches:
            for block, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                steps, c = unpacked(words.as_py())
                w = np.cumsum(steps)
                at = np.concatenate([[0], np.searchsorted(w, top), [len(w)]])
                yield _rows(["shard", "block", "words"], [pa.int32(), pa.int64(), pa.binary()],
                            [(s, block, packed(np.diff(w[a:b], prepend=np.uint64(0)), c[a:b])) for s, (a, b) in enumerate(zip(at[:-1], at[1:])) if a < b])

    def answer(batches):
        for some in runs(batches):
            shard = some.column(0)[0].as_py()
            got = [unpacked(x.as_py()) for x in some.column(2)]
            at = np.cumsum([0, *(len(g[0]) for g in got)])
            known, number = np.unique(np.concatenate([np.cumsum(g[0]) for g in got]), return_inverse=True)
            count = np.bincount(number, weights=np.concatenate([g[1] for g in got]), minlength=len(known)).astype(np.int64)
            del got
            for b, i, j in zip(some.column(1).to_pylist(), at[:-1], at[1:]):
                own = number[i:j]
                yield _rows(names, types, [(b, shard, packed(_narrow(np.diff(own, prepend=0)), _narrow(count[own])), None, None, None, None)])
            yield _rows(names, types, [(None, shard, None, len(known), int((count > 0).sum()), int(count.sum()), None)])
            place = np.flatnonzero(np.isin(known, ask_for))
            yield _rows(names, types, [(None, shard, None, None, None, i, w) for i, w in zip(place.tolist(), known[place].view(np.int64).tolist())])

    asked = (map_arrow(blocks.select("block", "words"), ask, "shard int, block long, words binary")
             .repartition(shards, "shard").sortWithinPartitions("shard"))
    return map_arrow(asked, answer, "block long, shard int, blob binary, words long, v long, n long, word long")


# --- step 3: bigram shards --------------------------------------------------------------------------------------------

class Trie:
    """A shard of the model: ``words`` (numbers in the whole vocabulary, with
    their counts), bigrams under their first word, and under each bigram the
    words before it."""

    def __init__(self, parts: dict):
        self.words, self.counts = parts["words"], parts["counts"]
        self.bigrams, self.before = parts["bigrams"], parts["before"]
        self.seen, self.backed, self.norm = parts["seen"], parts["backed"], parts["norm"]
        self.n, self.v = (float(x) for x in parts["totals"])

    @staticmethod
    def built(words, counts, u, v, w, times, n, v_total, totals=None) -> bytes:
        """The image of a trie from different training n-grams, sorted by (v, w,
        u) (places in ``words``), and how often each occurs; ``totals``: counts
        of bigrams of which the shard has a part, by (v, w)."""
        new2 = np.ones(len(v), dtype=bool)
        new2[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        own2 = np.cumsum(new2) - 1
        v2, w2, c2 = v[new2], w[new2], np.bincount(own2, weights=times, minlength=int(new2.sum()))
        if totals:
            c2 = np.array([totals.get(x, c) for x, c in zip(zip(v2.tolist(), w2.tolist()), c2)], dtype=float)
        p1 = (counts[w2] + 0.5) / (n + 0.5 * (v_total + 1))
        k = spread(counts[v2].astype(float))
        p2 = (c2 + k * p1) / (counts[v2] + k)
        return image(words=Monotone.of(words), counts=counts, totals=np.array([n, v_total], dtype=float),
                     bigrams=Level.of(len(words), v2, w2), before=Level.of(len(v2), own2, u),
                     seen=codes(np.log10(times + MU * p2[own2])), backed=codes(np.log10(MU * p2)), norm=codes(np.log10(c2 + MU)))

    def score(self, u, v, w, is_end) -> np.ndarray:
        """log10 of p3's numerator for n-grams sorted by (v, w, u) (places in
        ``words``), less, unless w is the end, log10 of the denominator of what
        follows (v, w)."""
        new2 = np.ones(len(v), dtype=bool)
        new2[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        own2 = np.cumsum(new2) - 1
        v2, w2 = v[new2], w[new2]
        cv = self.counts[v2].astype(float)
        k = spread(cv)
        backed = np.log10(MU * k / (cv + k) * (self.counts[w2] + 0.5) / (self.n + 0.5 * (self.v + 1)))
        norm = np.full(len(v2), np.log10(MU))
        two = self.bigrams.find(v2, w2)
        known = two >= 0
        backed[known], norm[known] = values(self.backed[two[known]]), values(self.norm[two[known]])
        out, at = backed[own2], np.flatnonzero(known[own2])
        three = self.before.find(two[own2][at], u[at])
        out[at[three >= 0]] = values(self.seen[three[three >= 0]])
        return out - np.where(is_end, 0.0, norm[own2])


_ROUTED = "shard long, block long, blob binary"
_ROUTED_TYPES = [pa.int64(), pa.int64(), pa.binary()]


def _numbered(base: list[np.ndarray], rank: np.ndarray, parts: list[dict], offsets: dict[int, int]):
    """Of a block: each token's word as its number in the whole vocabulary, and the words' counts."""
    ids, counts = [], []
    for p in sorted(parts, key=lambda p: p["shard"]):
        steps, count = unpacked(p["blob"])
        ids.append(np.cumsum(steps.astype(np.int64)) + offsets[p["shard"]])
        counts.append(count.astype(np.int64))
    ids, counts = np.concatenate(ids), np.concatenate(counts)  # by hash, as the block's words are
    by_rank, count_by_rank = np.empty_like(ids), np.empty_like(counts)
    by_rank[rank], count_by_rank[rank] = ids, counts
    return by_rank, count_by_rank


def _route(rows: DataFrame, shards: int, n: int, v: int, offsets: dict[int, int], hot: dict[tuple[int, int], int]) -> DataFrame:
    """shard, block, blob: the occurrences of a block for a shard; and with a
    negative shard what is known of its documents, those to learn from first.  ``hot``: by
    (v, w), numbers."""
    hot_keys = np.sort(_pair(*np.array(list(hot) or [(0, 0)], dtype=np.uint64).T)[:len(hot)])

    def run(batches):
        for batch in batches:
            for block, base, ranks, parts in zip(*(batch.column(i) for i in range(4))):
                base, rank = unpacked(base.as_py()), unpacked(ranks.as_py())[0]
                ids, counts = _numbered(base, rank, parts.as_py(), offsets)
                doc_ids, has_id, out, size, number = base
                number, size = number.astype(np.int32), size.astype(np.int64)
                doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
                p1 = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
                known = np.bincount(doc, weights=counts[number] > 0, minlength=len(size)).astype(np.int64)
                base_score = np.bincount(doc, weights=p1[number], minlength=len(size))
                first = np.argsort(out, kind="stable")
                yield _rows(["shard", "block", "blob"], _ROUTED_TYPES, [(-1 - block.as_py() % shards, block.as_py(), packed(
                    doc_ids[first], has_id[first], out[first], _narrow(size[first]), _narrow(known[first]), base_score[first]))])
                n_train = np.array([np.count_nonzero(~out)])
                place = np.empty(len(size), dtype=np.int32)
                place[first] = np.arange(len(size))
                doc = place[doc]
                mark = len(ids)
                ids, counts = np.append(ids, BEGIN_NUMBER), np.append(counts, 0)
                v_ = _before(number, size, mark)
                u = _before(v_, size, mark)
                pair = _pair(ids[v_].astype(np.uint64), ids[number].astype(np.uint64))
                if len(hot_keys):
                    spread_out = np.isin(pair, hot_keys)
                    pair[spread_out] = mix64(pair[spread_out] + ids[u[spread_out]].astype(np.uint64))
                shard = (pair % np.uint64(shards)).astype(np.int64)
                del pair
                order = np.argsort((shard * (mark + 1) + v_) * (mark + 1) + number, kind="stable") \
                    if shards * (mark + 1) ** 2 < 1 << 63 else np.lexsort((number, v_, shard))
                bounds = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
                del shard
                for s in np.flatnonzero(np.diff(bounds)).tolist():
                    own = order[bounds[s]:bounds[s + 1]]
                    three = np.stack([u[own], v_[own], number[own]])
                    same = np.ones(len(own), dtype=bool)  # neighbours in a document that are alike go once
                    same[1:] = (three[:, 1:] != three[:, :-1]).any(axis=0) | (doc[own][1:] != doc[own][:-1])
                    times = np.diff(np.append(np.flatnonzero(same), len(own)))
                    own, three = own[same], three[:, same]
                    there = np.zeros(mark + 1, dtype=bool)
                    there[three] = True
                    local = np.flatnonzero(there)
                    local = local[np.argsort(ids[local], kind="stable")]
                    spot = np.zeros(mark + 1, dtype=np.int64)
                    spot[local] = np.arange(len(local))
                    steps = np.diff(ids[local], prepend=0)
                    blob = packed(steps.astype(np.uint32 if len(steps) and steps.max() < 1 << 32 else np.int64), _narrow(counts[local]),
                                  *[_narrow(spot[x]) for x in three], _narrow(doc[own]), _narrow(times), n_train)
                    yield _rows(["shard", "block", "blob"], _ROUTED_TYPES, [(s, block.as_py(), blob)])

    return map_arrow(rows, run, _ROUTED)


def _answer(routed: DataFrame, n: int, v: int, n_docs: int, end: int, hot: dict[tuple[int, int], int], images: bool) -> DataFrame:
    """block, kind, blob: what is known of a block's documents (kind 0), sums of
    scores (kind 1), and with ``images`` the shards' tries (kind 2, block: the
    shard).  ``end``: the number of the end; ``hot``: by (v, w), numbers."""
    types = [pa.int64(), pa.int32(), pa.binary()]

    def run(batches):
        for some in runs(batches):
            shard = some.column(0)[0].as_py()
            if shard < 0:
                yield _rows(["block", "kind", "blob"], types, [(b.as_py(), 0, x.as_py()) for b, x in zip(some.column(1), some.column(2))])
                continue
            blobs = [unpacked(x.as_py()) for x in some.column(2)]
            words, number = np.unique(np.concatenate([np.cumsum(b[0].astype(np.int64)) for b in blobs]), return_inverse=True)
            number = number.astype(np.int32)
            counts = np.zeros(len(words), dtype=np.int64)
            counts[number] = np.concatenate([b[1] for b in blobs])
            counts[words == BEGIN_NUMBER] = n_docs  # before every document
            at = np.cumsum([0, *(len(b[0]) for b in blobs)])
            u, v_, w = (np.concatenate([number[a:][b[k]] for a, b in zip(at, blobs)]) for k in (2, 3, 4))
            times = np.concatenate([b[6] for b in blobs])
            train = np.concatenate([b[5] < b[7][0] for b in blobs])
            docs = [b[5] for b in blobs]
            del blobs, number
            size = len(words)
            order = np.argsort((v_.astype(np.int64) * size + w) * size + u, kind="stable") if size ** 3 < 1 << 63 else np.lexsort((u, w, v_))
            u, v_, w = u[order], v_[order], w[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (u[1:] != u[:-1]) | (v_[1:] != v_[:-1]) | (w[1:] != w[:-1])
            u, v_, w = u[new], v_[new], w[new]
            group = np.cumsum(new, dtype=np.int32) - 1
            learned = np.bincount(group, weights=np.where(train, times, 0)[order], minlength=len(u))
            known, totals = learned > 0, None
            if hot:
                totals = {}
                for (a, b), c in hot.items():
                    i, j = np.searchsorted(words, [a, b])
                    if i < size and j < size and words[i] == a and words[j] == b:
                        totals[int(i), int(j)] = c
                        known |= (v_ == i) & (w == j)  # even where the shard has no training occurrence
            raw = Trie.built(words, counts, u[known], v_[known], w[known], learned[known], n, v, totals)
            if images:
                yield _rows(["block", "kind", "blob"], types, [(shard, 2, raw)])
            score = np.empty(len(order))
            score[order] = Trie(opened(raw)).score(u, v_, w, words[w] == end)[group]
            del order, group, u, v_, w
            score *= times
            start = 0
            for block, doc in zip(some.column(1).to_pylist(), docs):
                total = np.bincount(doc, weights=score[start:start + len(doc)])
                start += len(doc)
                there = np.flatnonzero(total)
                yield _rows(["block", "kind", "blob"], types, [(block, 1, packed(_narrow(np.diff(there, prepend=0)), total[there].astype(np.float32)))])

    return map_arrow(routed, run, "block long, kind int, blob binary")


def _hot_bigrams(blocks: DataFrame, n_tokens: int) -> dict[int, tuple[int, int, int]]:
    """The bigrams with more than 1/1024 of all tokens, by hash: the hashes of
    their words and their training count.

    Such a bigram has that share in some block; those that do anywhere (fewer
    than 1024 of a block) are counted in all blocks, most frequent first.
    """
    likely = (blocks.select(F.explode("pairs").alias("pair"), "tokens").groupBy("pair").agg(F.sum("tokens").alias("t"))
              .orderBy(F.desc("t"), "pair"))
    # a pair's share is at most that of the blocks it was noted in, so no more than 1024 * 1024 can pass
    if not likely.limit(1).count():
        return {}
    noted = likely.where(F.col("t") * HOT_SHARE > n_tokens).select("pair")

    def counted(batches, wanted):
        for batch in batches:
            for base, ranks, words in zip(*(batch.column(i) for i in range(3))):
                base, words = unpacked(base.as_py()), np.cumsum(unpacked(words.as_py())[0])
                by_rank = np.empty_like(words)
                by_rank[unpacked(ranks.as_py())[0]] = words
                w = by_rank[base[4]]
                v = _before(w, base[3], BEGIN)
                pair, train = _pair(v, w), np.repeat(~base[2], base[3])
                here = np.flatnonzero(np.isin(pair, wanted))
                known, first, back = np.unique(pair[here], return_index=True, return_inverse=True)
                yield _rows(["pair", "v", "w", "n", "train"], [pa.int64()] * 5, list(zip(
                    known.view(np.int64).tolist(), v[here][first].view(np.int64).tolist(), w[here][first].view(np.int64).tolist(),
                    np.bincount(back, minlength=len(known)).tolist(),
                    np.bincount(back, weights=train[here], minlength=len(known)).astype(np.int64).tolist())))

    out: dict[int, tuple[int, int, int]] = {}
    block = 1 << 16  # candidates counted in one pass
    pairs = np.sort(noted.toArrow().column(0).to_numpy()).view(np.uint64)
    for i in range(0, len(pairs), block):
        wanted = pairs[i:i + block]
        found = (map_arrow(blocks.select("base", "ranks", "words"), lambda bs, wanted=wanted: counted(bs, wanted),
                           "pair long, v long, w long, n long, train long")
                 .groupBy("pair", "v", "w").agg(F.sum("n").alias("n"), F.sum("train").alias("train"))
                 .where(F.col("n") * HOT_SHARE > n_tokens).collect())  # at most 1024
        out |= {r["pair"] % (1 << 64): (r["v"] % (1 << 64), r["w"] % (1 << 64), r["train"]) for r in found}
    return out


# --- all steps --------------------------------------------------------------------------------------------------------

def _steps(docs: DataFrame, block_tokens: int, shard_tokens: int, images: bool):
    blocks = staged(_blocks(docs, block_tokens), "lm-blocks")
    n_tokens = int(blocks.agg(F.sum("tokens")).first()[0] or 0)
    hot = _hot_bigrams(blocks, n_tokens)
    # fewer words than tokens; several of a word in different blocks
    counted = staged(_word_counts(blocks, max(1, -(-n_tokens // (16 * shard_tokens))), {x for a, b, _ in hot.values() for x in (a, b)}), "lm-counts")
    told = counted.where("block is null").orderBy("shard").collect()  # a row for each word shard and hot word
    sizes = [r for r in told if r["word"] is None]
    offsets = dict(zip([r["shard"] for r in sizes], np.cumsum([0, *[r["words"] for r in sizes]]).tolist()))
    v, n = sum(r["v"] for r in sizes), sum(r["n"] for r in sizes)
    number = {r["word"] % (1 << 64): offsets[r["shard"]] + r["n"] for r in told if r["word"] is not None} | {int(BEGIN): BEGIN_NUMBER}
    by_number = {(number[a], number[b]): c for a, b, c in hot.values()}
    n_docs = docs.where(~F.coalesce("held_out", F.lit(False))).count()
    # a part for each word shard that the block has words in
    parts = counted.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("shard", "blob")).alias("parts"))
    shards = max(1, -(-n_tokens // shard_tokens))
    routed = _route(blocks.select("block", "base", "ranks").join(parts, "block").select("block", "base", "ranks", "parts"),
                    shards, n, v, offsets, by_number)
    answered = _answer(routed.repartition(shards, "shard").sortWithinPartitions("shard", "block"), n, v, n_docs, 0, by_number, images)
    return answered, n, n_docs


def score(docs: DataFrame, block_tokens: int = 4_000_000, shard_tokens: int = 2_000_000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, held_out): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows whose held_out is false or null.  A null or
    empty text is the end alone; repeated rows are learned and scored each; a
    null doc_id stays null; without any training row nothing is known, and an
    empty table gives no rows.
    """
    answered, n, n_docs = _steps(docs, block_tokens, shard_tokens, False)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def put_together(batches):
        for some in runs(batches):
            rows = [(k, unpacked(x)) for k, x in zip(some.column(1).to_pylist(), some.column(2).to_pylist())]
            ids, has_id, held, size, known, base = next(x for k, x in rows if k == 0)
            total = np.full(len(ids), -np.log10(n_docs + MU))
            for k, x in rows:
                if k == 1:
                    total[np.cumsum(x[0].astype(np.int64))] += x[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ma.array(ids, mask=~has_id).tolist(), pa.int64()), pa.array(held),
                pa.array(size.astype(np.int64)), pa.array(known.astype(np.int64)),
                pa.array(np.full(len(ids), n)), pa.array(base), pa.array(total)], types and names)

    met = answered.repartition("block").sortWithinPartitions("block", "kind")
    return map_arrow(met, put_together, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                        "base_score double, score double")


def model(docs: DataFrame, block_tokens: int = 4_000_000, shard_tokens: int = 2_000_000) -> DataFrame:
    """The trie itself: shard and its ``image``, to be opened in place or written
    to a file and memory-mapped (``elias_fano.mapped``)."""
    answered, _, _ = _steps(docs, block_tokens, shard_tokens, True)
    return answered.where("kind = 2").select(F.col("block").alias("shard"), F.col("blob").alias("image"))
