"""Text and staging helpers shared by the operators."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathfold.session import shared_dir

#: letters to lower case, everything outside digits, letters and non-ASCII to a blank
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage with files every executor can reach, so an executor that
    is lost later costs no recomputation of what was staged.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores behind it until no column has that name."""
    there = {c.lower() for c in taken}
    while wanted.lower() in there:
        wanted += "_"
    return wanted


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python import this package, wherever the driver found it (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="pathfold-py-"), "pathfold.zip")  # read by the driver only
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_WORKER_MEMORY: dict[str, dict] = {}


def worker_memory(name: str) -> dict:
    """What a Python worker remembers from one task of an operator to the next."""
    return _WORKER_MEMORY.setdefault(name, {})


def _forget_all_but(name: str | None) -> None:
    for other in _WORKER_MEMORY.keys() - {name}:
        _WORKER_MEMORY[other].clear()


def map_arrow(df: DataFrame, run, schema, keeps: str | None = None) -> DataFrame:
    """``mapInArrow``; of the worker's memories only the one named ``keeps`` stays.

    Right on another one, without a shuffle or a staged table between them, each
    task needs two workers at once, and Spark goes on using all of them in turn:
    such steps should be one function.
    """
    ship(df.sparkSession)

    def tidy(batches):
        _forget_all_but(keeps)
        yield from run(batches)
        pa.default_memory_pool().release_unused()  # the worker stays, for tasks that may need the executor's memory

    return df.mapInArrow(tidy, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def alnum_words(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and non-ASCII characters."""
    return text.translate(_FOLD).split()


def blank_words(text: bytes) -> list[bytes]:
    """Runs of anything but blanks and the five ASCII line and tab controls, A-Z lower-cased."""
    return text.lower().split()


def row_key(*cols: str):
    """A key for a row by content: rows alike in ``cols`` are one document."""
    return F.xxhash64(*[F.col(c) for c in cols])


# --- hashes of blank-separated words, for whole slices of text at once ------------------------------------------------

_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and where
    each text's words begin (one entry more than texts).  Words are as in
    ``blank_words``; the hash is a polynomial over their bytes, mixed."""
    joined = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    blank = np.concatenate([[True], _BLANK[joined], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[joined] * _powers(HASH_BASE, len(joined)), out=sums[1:])
    back = _powers(_BACK, len(joined) + 1)  # takes a sum back to the word's beginning
    words = mix64((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, np.concatenate([[0], ends_of_text]))


def text_slices(batches, text_at: int, most: int = 1 << 20):
    """Slices of record batches of about ``most`` bytes of text, or one long text, with the texts."""
    for whole in batches:
        column = whole.column(text_at)
        sizes = pc.binary_length(column.cast(pa.binary())).fill_null(0).to_pylist()
        i = 0
        while i < len(sizes):
            j, size = i + 1, sizes[i]
            while j < len(sizes) and size + sizes[j] < most:
                size += sizes[j]
                j += 1
            yield whole.slice(i, j - i), utf8(column.slice(i, j - i))  # a batch may have many times ``most``
            i = j


def runs(batches, key_at: int = 0):
    """The rows of a partition sorted by a key, as one table per key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key_at).to_numpy()
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            part = batch.slice(a, b - a)
            if held and held[-1].column(key_at)[0] != part.column(key_at)[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)
