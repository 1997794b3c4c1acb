"""Goal normalisation, conversion flags and tagged touches."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (CONVERSION_MARK, GLUE, NO_CONVERSION_MARK, OLD_CONVERSION_MARK,
                         OLD_GLUE, OLD_NO_CONVERSION_MARK, TRANSIT_ACTION)


def goal_target_or_transit(targets: Sequence[int]) -> Column:
    """A target goal stays, everything else (null included) becomes -1."""
    return F.when(F.col("goal").isin(*targets), F.col("goal")).otherwise(F.lit(TRANSIT_ACTION)).cast("bigint")


def goal_null_to_transit() -> Column:
    """Only a missing goal becomes -1; other goals keep their value."""
    return F.coalesce(F.col("goal"), F.lit(TRANSIT_ACTION).cast("bigint"))


def is_conversion(goal: Column | None = None) -> Column:
    """True for a normalised goal other than -1."""
    goal = F.col("goal") if goal is None else goal
    return goal != F.lit(TRANSIT_ACTION)


def conversion_mark(conv: Column, old_style: bool = False) -> Column:
    """Text marker of the conversion flag: get@conv / get@no_conv (or 1 / 0)."""
    yes, no = (OLD_CONVERSION_MARK, OLD_NO_CONVERSION_MARK) if old_style else (CONVERSION_MARK, NO_CONVERSION_MARK)
    return F.when(conv, F.lit(yes)).otherwise(F.lit(no))


def tagged_touch(channel: Column, conv: Column, old_style: bool = False) -> Column:
    """``channel::_get@conv`` style tag (``channel_1`` for the CSV era)."""
    glue = OLD_GLUE if old_style else GLUE
    return F.concat(channel, F.lit(glue), conversion_mark(conv, old_style))


def touch_map(tag: Column, ts: Column | None = None) -> Column:
    """One-entry map ``tagged touch -> HitTimeStamp`` (the touch record of the
    original jobs; inside plans the struct of ts, conv and channel is used)."""
    return F.create_map(tag, F.col("HitTimeStamp") if ts is None else ts)
