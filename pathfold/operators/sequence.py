"""Ordered client histories as window scans, heavy clients cut at range borders.

A client's hits are ordered by (HitTimeStamp, conv, channel): time, then a
plain touch before a conversion at the same instant, then channel.  Two
numbers per hit follow from that order:

* ``rn``  - its 1-based position in the client's history;
* ``seg`` - the number of conversions before it.  A conversion closes its own
  segment, so all hits with equal ``seg`` form one path.

First one aggregate per client runs (``overview``): it tells how many hits the
largest client has, counts conversions, and makes a filter of the clients that
the report keeps, which then stands before the hit shuffle.

Where no client is too large for a task, a client's history is one window
partition: one shuffle, no join.

Otherwise the hits are sorted as a whole: ``repartitionByRange`` on client and
order puts them into *slots* of like size, wherever a client begins or ends, and
writes them to the shared folder as a table bucketed by slot, so windows within
(slot, client) need no further shuffle.  A client that goes over a slot's border is
the last one of a slot or the first one of the next.  So two rows per slot, the
counts of its first and its last client, are all that has to be carried: they are
summed along the slots and joined, one row per slot.  Nothing is broadcast, no
list of heavy clients exists, a burst within a millisecond splits like anything
else, and the rows are the same whichever way is taken.
"""
from __future__ import annotations

import dataclasses
import os
import uuid

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .client_filter import ClientFilter, bits_of, only, useful_filter, word_of

ORDER = ("HitTimeStamp", "conv", "channel")
FLAGS = ("conv", "pre", "qual")
SLOTS_PER_BUCKET = 4  # so that slots meeting in one bucket even out


def heavy_limit(spark, share: int | None) -> int:
    """K: a client with more than 1/K of the hits is heavy.  As given, or so that
    it has more than two average shuffle partitions (and 1/64 of all hits)."""
    return share or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)


def _count_true(c: str) -> Column:
    return F.sum(F.col(c).cast("int"))


@dataclasses.dataclass(frozen=True)
class Overview:
    """What the aggregate per client tells about the scoped hits."""

    hits: int       # of all clients
    most: int       # of the largest client that is kept
    n_conv: int     # conversions of all clients
    n_pre: int      # of those flagged ``pre``
    kept_hits: int  # hits and conversions of the clients that are kept
    kept_conv: int
    goals: dict[int, tuple[int, int]]  # of each goal asked for: hits, and hits of a client with an id
    kept: ClientFilter | None          # the clients that are kept, if it pays to filter by it


def overview(scoped: DataFrame, clients: str = "all", goals: tuple[int, ...] = (), null_is_client: bool = True) -> Overview:
    """One aggregate of the scoped hits, combined map-side, that runs now; what
    reaches the driver is a row per word of the filter (see ``client_filter``).
    Without ``null_is_client`` hits without a client count for ``goals`` alone."""
    known = F.col("ClientID").isNotNull()
    counted = F.lit(True) if null_is_client else known
    kept = counted & {"all": F.lit(True), "converters": F.col("n_qual") > 0, "nonconverters": F.col("n_qual") == 0}[clients]
    per_client = scoped.groupBy("ClientID").agg(F.count(F.lit(1)).alias("n"), *[_count_true(c).alias(f"n_{c}") for c in FLAGS],
                                                 *[F.count_if(F.col("goal") == g).alias(f"goal{i}") for i, g in enumerate(goals)])
    total = lambda c, where, name: F.sum(F.when(where, F.col(c))).alias(name)
    sums = [total("n", counted, "hits"), total("n_conv", counted, "n_conv"), total("n_pre", counted, "n_pre"),
            total("n", kept, "kept_hits"), total("n_conv", kept, "kept_conv"),
            *[x for i in range(len(goals)) for x in (F.sum(f"goal{i}").alias(f"all{i}"), total(f"goal{i}", known, f"known{i}"))]]
    most = F.max(F.when(kept, F.col("n"))).alias("most")
    if clients == "all":
        told = per_client.agg(*sums, most).toArrow()
    else:
        told = (per_client.groupBy(F.when(kept, word_of(F.col("ClientID"))).otherwise(-1).alias("word"))
                .agg(F.bit_or(bits_of(F.col("ClientID"))).alias("bits"), *sums, most).toArrow())
    whole = lambda name: int(pc.sum(told[name]).as_py() or 0)
    words = None if clients == "all" else useful_filter(told.filter(pc.greater_equal(told["word"], 0)), whole("hits"))
    return Overview(whole("hits"), int(pc.max(told["most"]).as_py() or 0), whole("n_conv"), whole("n_pre"), whole("kept_hits"),
                    whole("kept_conv"), {g: (whole(f"all{i}"), whole(f"known{i}")) for i, g in enumerate(goals)}, words)


@dataclasses.dataclass(frozen=True)
class History:
    """Scoped hits with their window keys and, if they were cut into slots, the carries."""

    hits: DataFrame
    keys: tuple[str, ...]
    carry: DataFrame | None
    n_conv: int  # conversions of all clients
    n_pre: int   # of those flagged ``pre``


def ranged(scoped: DataFrame, buckets: int | None = None) -> DataFrame:
    """``scoped`` with its ``slot``, staged: sorted by client and order over all
    slots, in a table bucketed by slot.  Hits alike in client and order are told
    apart by their place in the input, so they split too."""
    spark = scoped.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ("ClientID", *ORDER)
    slots = (scoped.withColumn("_nth", F.monotonically_increasing_id())
             .repartitionByRange(SLOTS_PER_BUCKET * buckets, *by, "_nth").drop("_nth").withColumn("slot", F.spark_partition_id()))
    name = f"pathfold_slots_{uuid.uuid4().hex}"
    (slots.write.format("parquet").bucketBy(buckets, "slot").sortBy("slot", *by)
     .option("path", os.path.join(shared_dir(spark), name)).saveAsTable(name))
    return spark.table(name)


def slot_carry(slots: DataFrame) -> DataFrame:
    """One row per slot: ``first`` and ``last``, its first and its last client (one
    and the same, if it has no other), with that client's hits and conversions in
    the slots before (``hits_before``, ``conv_before``) and in all
    (``all_conv``, ``all_pre``, ``all_qual``).

    Only the first and the last client of a slot can have hits in another one.
    """
    counts = slots.groupBy("slot", "ClientID").agg(F.count(F.lit(1)).alias("n_hits"), *[_count_true(c).alias(f"n_{c}") for c in FLAGS])
    within = Window.partitionBy("slot").orderBy("ClientID")
    ends = (counts.withColumn("is_first", F.lag(F.lit(1)).over(within).isNull())
            .withColumn("is_last", F.lead(F.lit(1)).over(within).isNull()).where("is_first or is_last"))
    w = Window.partitionBy("ClientID").orderBy("slot")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    client = F.struct(
        F.col("ClientID").alias("client"), F.coalesce(F.sum("n_hits").over(before), zero).alias("hits_before"),
        F.coalesce(F.sum("n_conv").over(before), zero).alias("conv_before"),
        *[F.sum(f"n_{c}").over(whole).alias(f"all_{c}") for c in FLAGS])
    # an aggregate per slot of at most two rows; max skips nulls
    return (ends.select(F.col("slot").alias("own_slot"), "is_first", "is_last", client.alias("c")).groupBy("own_slot")
            .agg(F.max(F.when(F.col("is_first"), F.col("c"))).alias("first"), F.max(F.when(F.col("is_last"), F.col("c"))).alias("last")))


def history(scoped: DataFrame, share: int | None = None, least: int = 50_000, clients: str = "all", seen: Overview | None = None) -> History:
    """``scoped`` (ClientID, HitTimeStamp, channel, conv, qual, pre, ...) with
    window keys; a null ClientID is one client.  Hits of clients other than
    ``clients`` (converters, nonconverters or all) may be left out.  ``seen``: the
    overview of the same hits and clients, where it is there already."""
    seen = seen or overview(scoped, clients)
    if seen.kept is not None:
        scoped = only(scoped, seen.kept)
    if seen.most <= least or seen.most * heavy_limit(scoped.sparkSession, share) <= seen.hits:
        return History(scoped, ("ClientID",), None, seen.n_conv, seen.n_pre)
    slots = ranged(scoped)
    return History(slots, ("slot", "ClientID"), slot_carry(slots), seen.n_conv, seen.n_pre)


def numbered(found: History) -> DataFrame:
    """Every hit with ``rn``, ``seg`` and its client's totals (client_conv,
    client_pre, client_qual), partitioned by the history's keys."""
    w = Window.partitionBy(*found.keys).orderBy(*ORDER)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    local = found.hits.select(
        "*", F.row_number().over(w).cast("bigint").alias("rn"),
        F.coalesce(_count_true("conv").over(w.rowsBetween(Window.unboundedPreceding, -1)), zero).alias("seg"),
        *[_count_true(c).over(whole).alias(f"client_{c}") for c in FLAGS])
    if found.carry is None:
        return local
    joined = local.join(found.carry, local["slot"] == found.carry["own_slot"])
    at_first, at_last = (F.col("ClientID").eqNullSafe(F.col(f"{end}.client")) for end in ("first", "last"))
    return joined.select(
        *found.hits.columns, (F.col("rn") + F.when(at_first, F.col("first.hits_before")).otherwise(zero)).alias("rn"),
        (F.col("seg") + F.when(at_first, F.col("first.conv_before")).otherwise(zero)).alias("seg"),
        *[F.when(at_first, F.col(f"first.all_{x}")).when(at_last, F.col(f"last.all_{x}")).otherwise(F.col(f"client_{x}")).alias(f"client_{x}")
          for x in FLAGS])


def sequence(scoped: DataFrame, share: int | None = None, least: int = 50_000, clients: str = "all") -> DataFrame:
    """Every hit with its global ``rn`` and ``seg`` plus its client's totals."""
    return numbered(history(scoped, share, least, clients)).drop("slot")
