"""Best-fit packing of tokenised documents into fixed-length sequences.

Linear grouping: the large pieces of a bucket are sorted by length, cut into
groups of equal cardinality and rounded up to the longest of their group, so
that few distinct sizes remain.  Configurations of those sizes are chosen one
after the other: the largest size left, filled up by a bounded subset sum over
the others, used as often as the counts allow.  Then the actual pieces take
the places of their group, which leaves more room than the rounded sizes did,
and the small pieces go best-fit into what is left.

Scale: pieces are dealt to buckets by hash, about ``bucket_rows`` each, and
every bucket is packed by itself, so a task holds one bucket of lengths and
ids, whatever the size of the corpus or the lengths in it.  Each bucket may
leave one sequence partly filled, one in several thousand.
"""
from __future__ import annotations

import codecs
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, ship, text_slices, worker_memory

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: ASCII but white space, controls, digits and letters: a run of these after a letter is encoded apart
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())

#: bytes that a remembered word takes beside its letters and ids: two objects and their place in a dict
_ENTRY = 164

#: words encoded together, and the bytes of the longest word that is
_TOGETHER, _LONG = 512, 256


def _byte_letters() -> str:
    """The letter by which a byte-level tokenizer writes each of the 256 bytes; a blank stays."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    at = dict(zip(own + rest, own + list(range(256, 256 + len(rest))))) | {32: 32}
    return "".join(chr(at[b]) for b in range(256))


_BYTE_LETTERS = _byte_letters()


class WordEncoder:
    """Token ids of blank-separated words as little-endian 32-bit bytes, remembered.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words one after the other.  Words are remembered in
    two generations: when the younger has half of ``memory_mb`` (words, ids and
    what Python needs to keep them), it takes the place of the older, whose words
    are forgotten unless they were met again.  What is remembered thus stays below
    ``memory_mb`` and the new words of one slice of text.  Texts are split and their
    words numbered by Arrow, so a word is looked up once a slice.  New words are
    encoded many at a time; words of ``letters`` (European letters that the tokenizer
    only lower-cases, as asked of it for each) go to its model without its
    normalizer and pattern.
    """

    def __init__(self, path: str, memory_mb: float):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {c for c in map(chr, range(0x41, 0x530)) if c.isalpha() and self._is_plain(c)}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.most, self.held = memory_mb * (1 << 19), 0.0

    def _is_plain(self, c: str) -> bool:
        """Whether the model gives the tokenizer's ids for ``c`` in lower case, between letters and at the end."""
        word = f"a{c}a{c}"
        # (a sigma in upper case is lowered by its place)
        return c != "\u03a3" and np.array_equal(self._encode(word), self._encode_plain([word.encode()]))

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _encode_plain(self, words: list[bytes]) -> np.ndarray:
        low = b" ".join(words).decode().lower().encode()
        text = codecs.charmap_decode(low, "strict", _BYTE_LETTERS)[0]
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn_each(self, words: list[bytes]) -> None:
        """Words of any kind, each a sequence of its own to the tokenizer."""
        for i in range(0, len(words), _TOGETHER):
            some = words[i:i + _TOGETHER]
            texts = [w.decode("utf-8", "replace") for w in some]
            found = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
            ends = np.cumsum(np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(some)))
            self._keep(some, np.array(found.ids, dtype="<u4"), ends)

    def _learn_together(self, words: list[bytes], encode) -> None:
        """Words of letters: each ends with the one end-of-word token it has."""
        for i in range(0, len(words), _TOGETHER):
            some = words[i:i + _TOGETHER]
            ids = encode(some)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                self._keep(some, ids, ends)
            else:  # a letter the tokenizer splits on
                self._learn_each(some)

    def _keep(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        known, run, at = self.known, ids.tobytes(), 0
        for word, end in zip(words, (ends * 4).tolist()):
            known[word] = run[at:end]
            at = end

    def _learn(self, words: list[bytes]) -> None:
        """Different words, none of them known."""
        known, older, is_plain = self.known, self.older, self.letters.issuperset
        new, bases, parts = [], set(), []
        for word, ids in zip(words, map(older.get, words)):
            if ids is not None:
                known[word] = ids
            elif word.isalpha():  # ASCII letters
                new.append(word)
            else:
                base = word.rstrip(_PUNCTUATION)
                # a run of punctuation after a letter is a token run of its own
                if base and len(base) < len(word) and (97 <= base[-1] | 32 <= 122 or is_plain(base.decode("utf-8", "replace"))):
                    rest = word[len(base):]
                    parts.append((word, base, rest))
                    bases.add(base)
                    bases.add(rest)
                else:
                    new.append(word)
        bases.difference_update(new)
        for word in bases:
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    new.append(word)
        plain, letters, each = [], [], []
        for word in new:
            if not 0 < len(word) <= _LONG:
                known[word] = self._encode(word.decode("utf-8", "replace")).tobytes()
            elif is_plain(text := word.decode("utf-8", "replace")):
                plain.append(word)
            else:
                (letters if text.isalpha() else each).append(word)
        self._learn_together(plain, self._encode_plain)
        self._learn_together(letters, lambda some: self._encode(b" ".join(some).decode()))
        self._learn_each(each)
        for word, base, rest in parts:
            known[word] = known[base] + known[rest]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        # composing marks (these bytes begin them) may join with a letter differently in lower case
        low = pa.array([t if b"\xcc" in t or b"\xcd" in t else t.lower() for t in texts], pa.binary())
        split = pc.ascii_split_whitespace(low.view(pa.string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        if self.held > self.most:
            self.known, self.older, self.held = {}, self.known, 0.0
        known = self.known
        found = list(map(known.get, words))
        new = [w for w, ids in zip(words, found) if ids is None]
        if new:
            before = len(known)
            self._learn(new)
            added = len(known) - before  # the parts of words, too
            self.held += added * (_ENTRY + sum(len(w) + len(known[w]) for w in new) / len(new))
            found = [known[w] if ids is None else ids for w, ids in zip(words, found)]
        of_words = pa.array(found, pa.large_binary()).take(coded.indices)
        _, offsets, data = of_words.buffers()
        run = memoryview(data or b"")
        at = np.frombuffer(offsets, dtype=np.int64)[split.offsets.to_numpy()].tolist() if len(of_words) else [0] * (len(texts) + 1)
        return [bytes(run[i:j]) for i, j in zip(at[:-1], at[1:])]


def encoder(path: str, memory_mb: float) -> WordEncoder:
    """The worker's encoder, kept for its later tasks."""
    kept = worker_memory("encoders")
    if (path, memory_mb) not in kept:
        kept.clear()  # one at a time, so that the bound holds
        kept[path, memory_mb] = WordEncoder(path, memory_mb)
    return kept[path, memory_mb]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                 with_ids: bool = False, memory_mb: float = 80) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text; other columns are not read) and cut.

    One row per piece: doc_id, piece, start, length, ids_crc32 and, with
    ``with_ids``, the ids as little-endian 32-bit ``ids`` binary.  Every text is
    followed by ``end_id``; a null or empty text is that id alone.  Only longer
    documents than ``capacity`` are cut.  Repeated rows give repeated pieces, a
    null doc_id stays null, an empty table gives no piece.  ``memory_mb`` bounds what
    one Python worker (there is one per core) remembers of words; more of it is faster.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    end = int(end_id).to_bytes(4, "little")
    width = 4 * capacity
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path, memory_mb)
        for batch, texts in text_slices(batches, 1, 2 << 20):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), words.encode(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    rows.append((doc_id, k, k * capacity, len(part) // 4, zlib.crc32(part), part)[:len(names)])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(own, run, schema, keeps="encoders")


def configurations(sizes: list[int], counts: list[int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """Ways to fill a sequence with ``sizes`` (descending) and how often to use each.

    Each takes the largest size left and the subset of the others, no more of
    one than are left, that comes closest to the capacity.
    """
    counts = list(counts)
    first = 0
    while True:
        while first < len(sizes) and not counts[first]:
            first += 1
        if first == len(sizes):
            return
        room = capacity - sizes[first]
        mask, reach, steps = (1 << room + 1) - 1, 1, []
        for j in range(first, len(sizes)):
            most = min(counts[j] - (j == first), room // sizes[j])
            n = 1
            while most > 0:
                n = min(n, most)
                steps.append((reach, j, n))
                reach |= reach << n * sizes[j] & mask
                most -= n
                n *= 2
            if reach >> room:
                break
        fill = reach.bit_length() - 1
        used = Counter({first: 1})
        for before, j, n in reversed(steps):
            if not before >> fill & 1:
                used[j] += n
                fill -= n * sizes[j]
        times = min(counts[j] // n for j, n in used.items())
        for j, n in used.items():
            counts[j] -= n * times
        yield dict(used), times


def pack_lengths(lengths: np.ndarray, capacity: int, groups: int = 1024, small: float = 1 / 4
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each of ``lengths`` (any of 0 to capacity)."""
    n = len(lengths)
    if n and (lengths.max() > capacity or lengths.min() < 0):
        raise ValueError("a piece is longer than a sequence")
    sequence, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    n_large = int(np.count_nonzero(lengths > capacity * small))
    large, rest = order[:n_large], order[n_large:]
    used: list[int] = []

    by_size: dict[int, list[int]] = {}
    for group in np.array_split(large, min(groups, n_large)) if n_large else ():
        by_size.setdefault(int(lengths[group[0]]), []).extend(group.tolist())
    sizes = sorted(by_size, reverse=True)
    own = lengths.tolist()
    for config, times in configurations(sizes, [len(by_size[s]) for s in sizes], capacity):
        for _ in range(times):
            at = 0
            for j, count in config.items():
                for _ in range(count):
                    i = by_size[sizes[j]].pop()
                    sequence[i], offset[i] = len(used), at
                    at += own[i]
            used.append(at)

    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = 0
    for s, at in enumerate(used):
        open_[capacity - at].append(s)
        bits |= 1 << capacity - at
    for i in rest.tolist():
        size = own[i]
        fits = bits >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            s = open_[room].pop()
            if not open_[room]:
                bits ^= 1 << room
        else:
            room, s = capacity, len(used)
            used.append(0)
        sequence[i], offset[i] = s, used[s]
        used[s] += size
        open_[room - size].append(s)
        bits |= 1 << room - size
    return sequence, offset


def pack_pieces(pieces: DataFrame, capacity: int = 2048, bucket_rows: int = 32768) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (a staged table with a long
    ``length``; columns of these two names are replaced).

    Ties in length are taken in any order; repeated rows are packed each, and are
    dealt to buckets by their places in the table, so they do not meet in one.
    """
    kept, bucket_ = pieces.drop("sequence_id", "offset"), free_name(pieces.columns, "_bucket")
    n_buckets = max(1, -(-kept.count() // bucket_rows))
    keys = [c for c in ("doc_id", "piece", "ids_crc32") if c in kept.columns] or kept.columns
    names = kept.columns
    ship(kept.sparkSession)
    schema = kept.schema.add("sequence_id", "long").add("offset", "long")

    def pack(pdf):
        bucket = int(pdf[bucket_].iloc[0])
        sequence, offset = pack_lengths(pdf["length"].to_numpy(dtype=np.int64), capacity)
        return pdf[names].assign(sequence_id=sequence + (bucket << 32), offset=offset)

    return (kept.withColumn(bucket_, F.pmod(F.xxhash64(*keys, F.monotonically_increasing_id()), F.lit(n_buckets)))
            .groupBy(bucket_).applyInPandas(pack, schema))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array<int>) and the
    doc_id and offset of each piece.  A sequence has at most the capacity's
    tokens, so a group is bounded."""
    part = F.struct("offset", "doc_id", "piece", "ids")
    return (packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
            .select("sequence_id", F.transform("p", lambda x: F.struct(x.doc_id, x.piece, x.offset)).alias("pieces"),
                    F.array_join(F.transform("p", lambda x: F.hex(x.ids)), "").alias("h"))
            .select("sequence_id", "pieces", F.unhex("h").alias("ids")))
