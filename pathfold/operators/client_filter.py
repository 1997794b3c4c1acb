"""A Bloom filter of clients, as a small table and a semi-join.

The filter is an array of ``WORDS`` 64-bit words.  A client's hash picks one word
and up to four bits in it.  Only words with a bit are rows, so the table has no
more rows than there are clients in it, and never more than ``WORDS`` (4 MB of
numbers): that bounds its broadcast, however large the log.  A client outside passes
as often as chance sets its bits; the report's own condition drops it later, so
the filter changes what is shuffled and never a result.

Beyond about three million clients too many bits are set; then, or where most
hits belong to clients that are kept, no filter is used.
"""
from __future__ import annotations

import dataclasses

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18
FULL = 0.5     # share of bits set from which the filter lets too much pass
WORTH = 0.75   # share of the hits that may pass for the filter to pay


@dataclasses.dataclass(frozen=True)
class ClientFilter:
    words: pa.Table  # word, bits


def word_of(client: Column) -> Column:
    return F.pmod(F.xxhash64(client), F.lit(WORDS))


def bits_of(client: Column) -> Column:
    h = F.xxhash64(client, F.lit(1))
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def useful_filter(told: pa.Table, hits: int) -> ClientFilter | None:
    """The filter made of ``told`` (word, bits, kept_hits: one row per word), if it pays
    for a log with ``hits`` hits."""
    n_set = sum(x.bit_count() for x in (b & (1 << 64) - 1 for b in told["bits"].to_pylist()))
    if n_set > FULL * 64 * WORDS or (pc.sum(told["kept_hits"]).as_py() or 0) > WORTH * hits:
        return None
    return ClientFilter(told.select(["word", "bits"]))


def only(hits: DataFrame, kept: ClientFilter) -> DataFrame:
    """Hits of the clients in the filter, and of few others."""
    spark = hits.sparkSession
    words = spark.createDataFrame(kept.words, "word bigint, bits bigint")
    probe = hits.select("*", word_of(F.col("ClientID")).alias("_word"), bits_of(F.col("ClientID")).alias("_bits"))
    match = (probe["_word"] == words["word"]) & (words["bits"].bitwiseAND(probe["_bits"]) == probe["_bits"])
    return probe.join(F.broadcast(words), match, "left_semi").drop("_word", "_bits")  # WORDS rows at most
