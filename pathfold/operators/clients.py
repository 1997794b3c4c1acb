"""Client sets and client selection.

Sets are distinct-aggregates (partial aggregation on the map side, so a busy
client costs one row per map task).  Selection is a semi / anti join against
such a set with no broadcast hint: adaptive execution broadcasts the set only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
splits skewed join partitions otherwise.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def converters(scoped: DataFrame, qual: str = "qual") -> DataFrame:
    """Distinct clients with at least one qualifying (in-window) conversion."""
    return scoped.filter(F.col(qual)).select("ClientID").distinct()


def nonconverters(scoped: DataFrame, qual: str = "qual") -> DataFrame:
    """All clients EXCEPT converters, as one aggregate instead of an
    anti-join of two distinct sets (a null client is one group, as in EXCEPT)."""
    return (scoped.groupBy("ClientID").agg(F.max(F.col(qual)).alias("_converted"))
            .filter(~F.col("_converted")).select("ClientID"))


def converter_hits(scoped: DataFrame, qual: str = "qual") -> DataFrame:
    """Hits of converters (a null client never joins)."""
    return scoped.join(converters(scoped, qual), "ClientID", "left_semi")


def nonconverter_hits(scoped: DataFrame, qual: str = "qual") -> DataFrame:
    """Hits of non-null clients that are not converters."""
    return (scoped.filter(F.col("ClientID").isNotNull())
            .join(converters(scoped, qual), "ClientID", "left_anti"))
