"""Channels as numbers, so that histories and paths are shuffled without their text.

A log has few distinct channels and many hits.  One aggregate finds the channels;
their numbers are their places in byte order, which is Spark's order of strings, so
hits sort alike by number and by text.  A small join puts the numbers in before
the hit shuffle, paths are collected, shuffled and counted as arrays of numbers, and
text is made of what is left at the end.

The list is a literal of the plan and a broadcast: it is used only up to
``MOST_CHANNELS`` channels and ``MOST_BYTES`` of text.  A log with more (a channel
part that is different in every hit) keeps its text.
"""
from __future__ import annotations

import dataclasses
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import PATH_SEPARATOR

MOST_CHANNELS = 1 << 14
MOST_BYTES = 1 << 20


@dataclasses.dataclass(frozen=True)
class ChannelNumbers:
    """Channels in byte order; a channel's number is its place, from 0."""

    names: tuple[str, ...]

    def numbered(self, scoped: DataFrame) -> DataFrame:
        """``scoped`` with the number in place of the channel; a channel that isn't
        in the list fails the job, a null one stays null."""
        known = scoped.sparkSession.createDataFrame(
            pa.table({"name": pa.array(self.names, pa.string()), "number": pa.array(range(len(self.names)), pa.int32())}), "name string, number int")
        channel, number = F.col("channel"), F.col("number")
        lost = F.raise_error(F.concat(F.lit("a channel that the list of channels lacks: "), channel)).cast("int")
        joined = scoped.join(F.broadcast(known), scoped["channel"] == known["name"], "left")  # MOST_CHANNELS rows at most
        found = F.when(number.isNotNull() | channel.isNull(), number).otherwise(lost)
        return joined.select(*[found.alias(c) if c == "channel" else F.col(c) for c in scoped.columns])

    def text(self, path: Column) -> Column:
        """The joined names of an array of numbers."""
        names = F.from_json(F.lit(json.dumps(self.names)), "array<string>")  # folded into a literal array
        return F.array_join(F.transform(path, lambda i: F.element_at(names, i + 1)), PATH_SEPARATOR)


def channel_numbers(scoped: DataFrame, most: int = MOST_CHANNELS, most_bytes: int = MOST_BYTES) -> ChannelNumbers | None:
    """The channels of ``scoped``, found now by one aggregate (combined map-side);
    None if there are more than ``most`` or they have more than ``most_bytes``."""
    length = F.octet_length("channel")
    # what is too long by itself comes as a null
    found = (scoped.where(F.col("channel").isNotNull()).select(F.when(length <= most_bytes, F.col("channel")).alias("channel"))
             .distinct().limit(most + 1).toArrow()["channel"].to_pylist())
    if len(found) > most or None in found or sum(len(c.encode()) for c in found) > most_bytes:
        return None
    return ChannelNumbers(tuple(sorted(found, key=str.encode)))
