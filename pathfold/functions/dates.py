"""Calendar days and timestamps to epoch milliseconds, as column expressions.

Both work on ``timestamp_ntz`` values, so the result does not depend on the
session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DEFAULT_ZONE


def epoch_ms_ntz(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 00:00 of a timestamp_ntz (truncated)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def local_midnight_ms(day: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Epoch ms of local midnight of ``day`` (yyyy-MM-dd string or date) in ``zone``."""
    local = F.to_timestamp_ntz(F.to_date(day).cast("string"))
    return epoch_ms_ntz(F.convert_timezone(F.lit(zone), F.lit("UTC"), local))
