"""Paths: a client's history cut after every conversion.

Hits get their segment number and their client's totals (``sequence``), those
of segments or clients the report does not keep are dropped, and only then is
text collected: one row per (client, segment), on the partitioning the window
made.  If histories were cut into slots, a slot's stretch of a segment (a *piece*)
is collected first and the pieces are put together in slot order.

Order comes from explicit sort keys (``rn``, ``slot``), never from the order
rows happen to arrive in.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PATH_SEPARATOR
from .sequence import History, numbered

MODES = ("success", "fail", "both")
CLIENTS = ("converters", "nonconverters", "all")


def segment_filter(mode: str = "both", clients: str = "all", trim: bool = False) -> Column | None:
    """Which segments a report keeps, from the segment number and client totals.

    trim          - drop everything up to the client's last conversion before
                    the report start (the look-back cut);
    success       - closed segments (ending in a conversion);
    fail          - the open tail after the client's last conversion;
    converters    - clients with a qualifying conversion;
    nonconverters - clients without one.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if clients not in CLIENTS:
        raise ValueError(f"clients must be one of {CLIENTS}, got {clients!r}")
    seg, n, p, q = (F.col(c) for c in ("seg", "client_conv", "client_pre", "client_qual"))
    conds = []
    if trim:
        conds.append(seg >= p)
    if mode == "success":
        conds.append(seg < n)
    elif mode == "fail":
        conds.append(seg == n)
    if clients == "converters":
        conds.append(q > 0)
    elif clients == "nonconverters":
        conds.append(q == 0)
    out = None
    for c in conds:
        out = c if out is None else out & c
    return out


def _joined(items: Column, field: str) -> Column:
    # field of an array of structs -> array of that field (no lambda, so no
    # interpreted higher-order function per element)
    return F.array_join(items[field], PATH_SEPARATOR)


def segments(found: History, mode: str = "both", clients: str = "all", trim: bool = False,
             timeline: bool = True, numbered_channels: bool = False) -> DataFrame:
    """Kept segments of a client history as rows ClientID, seg, user_path,
    [timeline,] status, n_touches.

    ``timeline=False`` leaves the timeline out (column and all its text):
    reports that only count paths do not build or shuffle it.  With
    ``numbered_channels`` channels are numbers and user_path is an array of them
    (see ``channels``).  Drop the hits of a null ClientID beforehand if they are no
    client.
    """
    joined = lambda items, t: items["channel"] if numbered_channels and t == "channel" else _joined(items, t)
    hits = numbered(found)
    cond = segment_filter(mode, clients, trim)
    if cond is not None:
        hits = hits.filter(cond)
    # sort_array orders structs by their first field with a natural-order
    # comparator (array_sort without a comparator runs a lambda per comparison)
    fields = [F.col("rn"), F.col("channel")]
    texts = ["user_path"]
    if timeline:
        fields.append(F.col("HitTimeStamp").cast("string").alias("ts"))
        texts.append("timeline")
    items = F.sort_array(F.collect_list(F.struct(*fields))).alias("items")
    stretch = (hits.groupBy(*found.keys, "seg").agg(items, F.max("conv").alias("status"), F.count(F.lit(1)).alias("n_touches"))
               .select(*found.keys, "seg", *[joined(F.col("items"), f).alias(t) for f, t in zip(("channel", "ts"), texts)],
                       "status", "n_touches"))
    if found.carry is None:
        return stretch
    parts = F.sort_array(F.collect_list(F.struct("slot", *texts))).alias("parts")
    return (stretch.groupBy("ClientID", "seg").agg(parts, F.max("status").alias("status"), F.sum("n_touches").alias("n_touches"))
            .select("ClientID", "seg", *[(F.flatten(F.col("parts")[t]) if numbered_channels and t == "user_path" else _joined(F.col("parts"), t)).alias(t)
                                         for t in texts], "status", "n_touches"))
