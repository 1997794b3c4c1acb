"""Elias-Fano coded levels of an n-gram trie, as flat buffers.

Everything is laid out in one buffer that is read in place (bytes, an Arrow
buffer or a memory-mapped file); a batch of sorted queries decodes each chunk
of a level at most once.
"""
from __future__ import annotations

import json
import mmap

import numpy as np

CHUNK = 1 << 16


class Monotone:
    """A non-decreasing sequence of non-negative integers: the low bits of each
    value packed, the high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> Monotone:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(place[-1]) + 1) if n else 0, dtype=bool)
        unary[place] = True
        lows = [np.packbits(((values[i:i + CHUNK, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8))
                for i in range(0, n, CHUNK)] if low_bits else []
        return cls(n, low_bits, np.concatenate(lows) if lows else np.zeros(0, np.uint8), np.packbits(unary),
                   np.append(place[::CHUNK], len(unary)))

    def chunk(self, c: int) -> np.ndarray:
        """Values number c * CHUNK and on."""
        count = min(CHUNK, self.n - c * CHUNK)
        a, b = int(self.samples[c]), int(self.samples[c + 1])
        bits = np.unpackbits(self.high[a >> 3:(b + 7) >> 3])[a & 7:(a & 7) + b - a]
        value = (np.flatnonzero(bits)[:count] + a - np.arange(c * CHUNK, c * CHUNK + count)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            at = c * CHUNK * self.low_bits // 8
            low = np.unpackbits(self.low[at:at + (count * self.low_bits + 7) // 8])[:count * self.low_bits].reshape(count, -1)
            for k in range(self.low_bits):
                value |= low[:, k].astype(np.uint64) << np.uint64(k)
        return value

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at the positions ``at`` (ascending)."""
        out = np.zeros(len(at), dtype=np.uint64)
        bounds = np.searchsorted(at, np.arange(0, self.n + CHUNK, CHUNK))
        for c, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if a < b:
                out[a:b] = self.chunk(c)[at[a:b] - c * CHUNK]
        return out

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending ``wanted`` the position of the first value not below
        each (n if none), and whether it is equal."""
        at, equal = np.full(len(wanted), self.n, dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        done = 0
        for c in range(-(-self.n // CHUNK)):
            if done == len(wanted):
                break
            values = self.chunk(c)
            upto = done + int(np.searchsorted(wanted[done:], values[-1], "right"))
            if upto > done:
                place = np.searchsorted(values, wanted[done:upto])
                at[done:upto] = place + c * CHUNK
                equal[done:upto] = values[place] == wanted[done:upto]
                done = upto
        return at, equal


class Level:
    """The successors of contexts 0, 1, ...: pointers to where each context's
    begin, and the successors relative to the last one of the context before,
    which makes them one monotone sequence."""

    def __init__(self, pointers: Monotone, words: Monotone):
        self.pointers, self.words = pointers, words

    @classmethod
    def of(cls, n_contexts: int, context: np.ndarray, word: np.ndarray) -> Level:
        """From (context, word) pairs sorted by both, all different."""
        pointers = np.searchsorted(context, np.arange(n_contexts + 1))
        last = np.where(pointers[1:] > pointers[:-1], word[np.maximum(pointers[1:], 1) - 1] + 1 if len(word) else 0, 0)
        base = np.concatenate([[0], np.cumsum(last)])
        return cls(Monotone.of(pointers), Monotone.of(base[context] + word if len(word) else word))

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Position of each (context, word), sorted by both, or -1."""
        if not len(context) or not self.words.n:
            return np.full(len(context), -1, dtype=np.int64)
        own, back = np.unique(context, return_inverse=True)
        first, end = self.pointers.get(own).astype(np.int64), self.pointers.get(own + 1).astype(np.int64)
        base = np.zeros(len(own), dtype=np.uint64)
        base[first > 0] = self.words.get(first[first > 0] - 1) + np.uint64(1)
        wanted = base[back] + word.astype(np.uint64)
        # a word beyond its context's last one would run into the next context
        order = np.argsort(wanted, kind="stable")
        at, equal = (x[np.argsort(order, kind="stable")] for x in self.words.successor(wanted[order]))
        return np.where(equal & (at < end[back]) & (at >= first[back]), at, -1)


def image(**parts) -> bytes:
    """Arrays, Monotones and Levels in one buffer with a header."""
    flat: dict[str, np.ndarray] = {}

    def put(name, x):
        if isinstance(x, Level):
            put(name + ".pointers", x.pointers)
            put(name + ".words", x.words)
        elif isinstance(x, Monotone):
            flat[name + ".head"] = np.array([x.n, x.low_bits], dtype=np.int64)
            flat.update({name + ".samples": x.samples, name + ".low": x.low, name + ".high": x.high})
        else:
            flat[name] = np.asarray(x)

    for name, x in parts.items():
        put(name, x)
    blobs, head, at = [], {}, 0
    for name, x in flat.items():
        head[name] = (str(x.dtype), len(x), at)
        raw = np.ascontiguousarray(x).tobytes()
        blobs.append(raw + bytes(-len(raw) % 8))
        at += len(blobs[-1])
    told = json.dumps(head).encode()
    told += b" " * (-len(told) % 8)
    return len(told).to_bytes(8, "little") + told + b"".join(blobs)


def opened(buffer) -> dict:
    """The parts of an image, as views on ``buffer`` (bytes, a memoryview or an mmap)."""
    size = int.from_bytes(buffer[:8], "little")
    head = json.loads(bytes(buffer[8:8 + size]))
    flat = {k: np.frombuffer(buffer, dtype=d, count=n, offset=8 + size + at) for k, (d, n, at) in head.items()}

    def monotone(name):
        n, low_bits = flat[name + ".head"].tolist()
        return Monotone(n, low_bits, flat[name + ".low"], flat[name + ".high"], flat[name + ".samples"])

    out: dict = {}
    for name in flat:
        top, _, rest = name.partition(".")
        if not rest:
            out[top] = flat[name]
        elif top not in out:
            out[top] = Level(monotone(top + ".pointers"), monotone(top + ".words")) if rest.split(".")[0] in ("pointers", "words") else monotone(top)
    return out


def mapped(path: str) -> dict:
    """The parts of an image in a file, memory-mapped."""
    with open(path, "rb") as f:
        return opened(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
