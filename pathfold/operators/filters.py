"""Row filters of the hit log.

Every predicate is a plain column expression on hit columns, so on a parquet
hit log Catalyst pushes it to the reader (``PushedFilters``) and row groups
outside the time range or project are skipped.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TRANSIT_ACTION


def time_range(lower_ms: int, upper_ms: int) -> Column:
    """Half-open ``lower <= HitTimeStamp < upper``."""
    ts = F.col("HitTimeStamp")
    return (ts >= F.lit(lower_ms)) & (ts < F.lit(upper_ms))


def project_is(project_id: int) -> Column:
    return F.col("ProjectID") == F.lit(project_id)


def goal_null_or_target(targets: Sequence[int]) -> Column:
    """Plain touches and target goals; any other goal (-1 included) is dropped."""
    return F.col("goal").isNull() | F.col("goal").isin(*targets)


def goal_target_or_transit(targets: Sequence[int], goal: Column | None = None) -> Column:
    """After null -> -1: target goals and -1 survive."""
    goal = F.col("goal") if goal is None else goal
    return goal.isin(*targets, TRANSIT_ACTION)


def platform_in(platforms: Sequence[str]) -> Column:
    """``src`` in the list; a null platform never matches."""
    return F.col("src").isin(*platforms)


def product_is(product: str | None) -> Column | None:
    """Product equality, or None when no product was asked for."""
    return None if product is None else F.col("ga_location") == F.lit(product)


def apply(df: DataFrame, *predicates: Column | None) -> DataFrame:
    """Filter by the conjunction of the given predicates (None ones skipped)."""
    cond = None
    for p in predicates:
        if p is not None:
            cond = p if cond is None else cond & p
    return df if cond is None else df.filter(cond)
