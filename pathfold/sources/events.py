"""Hit log derived from the generic ``events`` table.

The mapping is a fixture contract: the same rules are written as SQL in the
DuckDB oracle, so both engines see identical hits.
"""
from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import epoch_ms_ntz
from .hits import to_hit_schema


def events_to_hits(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Hits of ``events``, with its columns ``keep`` beside the hit schema."""
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    mod = lambda c, n: (c % n).cast("string")
    hits = events.select(
        F.when(eid % 10 == 0, F.lit(1)).otherwise(F.lit(3)).cast("bigint").alias("ProjectID"),
        F.concat(uid.cast("string"), F.lit("_"), mod(eid, 7)).alias("ClientID"),
        # epoch ms of a timestamp_ntz, independent of the session time zone
        epoch_ms_ntz(F.col("ts")).alias("HitTimeStamp"),
        F.when((eid % 4).isin(2, 3), F.concat(F.lit("site"), mod(uid, 3), F.lit(" / cpc"))).alias("ga_sourcemedium"),
        F.concat(F.lit("u"), mod(eid, 3)).alias("utm_source"),
        F.lit("cpm").alias("utm_medium"),
        F.when(eid % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), mod(eid, 2))).alias("utm_campaign"),
        F.when(etype == "view", F.lit("view")).otherwise(F.lit("click")).alias("interaction_type"),
        F.concat(F.lit("pl"), mod(eid, 2)).alias("dcm_placement_id"),
        F.concat(F.lit("pr"), mod(eid, 2)).alias("profile"),
        F.concat(F.lit("p"), mod(eid, 2)).alias("ga_location"),
        F.when(etype == "signup", 3).when(etype == "purchase", 5).when(etype == "error", 7)
         .cast("bigint").alias("goal"),
        F.when(eid % 4 == 0, "adriver").when(eid % 4 == 1, "dcm").when(eid % 4 == 2, "ga")
         .otherwise("bq").alias("src"),
        *keep,
    )
    return hits.select(*to_hit_schema(hits).columns, *keep)


def _ntz(ms: int) -> Column:
    """The timestamp_ntz whose epoch-ms value (as HitTimeStamp computes it) is ``ms``."""
    t = datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hits_from_events(spark: SparkSession, sf_dir: str, since_ms: int | None = None,
                     until_ms: int | None = None) -> DataFrame:
    """Hits of the ``events`` table; with ``since_ms`` / ``until_ms`` only those
    with since <= HitTimeStamp < until.  That range is also put on ``ts``
    itself (exactly the same rows: HitTimeStamp truncates ts to the ms), so
    the parquet reader skips row groups outside it."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    if since_ms is not None:
        events = events.filter(F.col("ts") >= _ntz(since_ms))
    if until_ms is not None:
        events = events.filter(F.col("ts") < _ntz(until_ms))
    return events_to_hits(events)
