"""The report variants and how each one scopes the hit log.

| variant   | lower bound | goal rule                           | null client | trim | paths kept                  |
|-----------|-------------|-------------------------------------|-------------|------|-----------------------------|
| canonical | look-back   | keep null/target goals, rest -> out | dropped     | yes  | by achieve_mode             |
| v3        | look-back   | null -> -1, keep target / -1        | dropped     | yes  | converters' success         |
| null      | start       | null -> -1, all kept, all touches   | dropped     | no   | non-converters' fail        |
| v2        | start       | null -> -1, keep target / -1        | kept        | no   | everyone's success and fail |
| csv       | start       | null -> -1, keep target / -1        | kept        | no   | everyone's success          |
"""
from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.channel import channel_label, utm_source_channel
from ..functions.goals import goal_null_to_transit, goal_target_or_transit, is_conversion
from ..operators import filters
from ..params import JobParams

GOAL_RULES = ("drop_nontarget", "transit", "erase")


@dataclasses.dataclass(frozen=True)
class Variant:
    name: str
    lookback: bool            # lower time bound is the look-back day (else the start)
    goal_rule: str            # see GOAL_RULES
    trim: bool                # cut history before the last pre-start conversion
    keep_null_client: bool    # a null ClientID is one client of the report
    channel: str = "label"    # "label" (platform rules) or "utm_source"
    old_marks: bool = False   # 1/0 conversion marks with '_' glue
    # which paths of which clients the report keeps; None for both means
    # "from achieve_mode": converters' success paths or non-converters' fail paths
    mode: str | None = None       # "success" | "fail" | "both"
    clients: str | None = None    # "converters" | "nonconverters" | "all"
    # channel parts a hit log must have for this variant (older logs lack some)
    parts: tuple[str, ...] = ("ga_sourcemedium", "utm_source", "utm_medium", "interaction_type", "profile")

    def needed(self, params: JobParams) -> tuple[str, ...]:
        """Columns, besides the keys, that the variant's reports read."""
        return self.parts + (("ga_location",) if params.product is not None else ())

    def __post_init__(self):
        if self.goal_rule not in GOAL_RULES:
            raise ValueError(f"goal_rule must be one of {GOAL_RULES}")
        if (self.mode is None) != (self.clients is None):
            raise ValueError("give both mode and clients, or neither")

    def selection(self, params: JobParams) -> tuple[str, str]:
        """(mode, clients) of the variant's path report."""
        if self.mode is not None:
            return self.mode, self.clients
        return ("success", "converters") if params.converted else ("fail", "nonconverters")


CANONICAL = Variant("canonical", lookback=True, goal_rule="drop_nontarget", trim=True, keep_null_client=False,
                    parts=Variant.parts + ("utm_campaign", "dcm_placement_id"))
V3 = Variant("v3", lookback=True, goal_rule="transit", trim=True, keep_null_client=False,
             mode="success", clients="converters", parts=Variant.parts + ("utm_campaign",))
NULL = Variant("null", lookback=False, goal_rule="erase", trim=False, keep_null_client=False,
               mode="fail", clients="nonconverters", parts=Variant.parts + ("utm_campaign",))
V2 = Variant("v2", lookback=False, goal_rule="transit", trim=False, keep_null_client=True,
             mode="both", clients="all")
CSV_ERA = Variant("csv", lookback=False, goal_rule="transit", trim=False, keep_null_client=True,
                  channel="utm_source", old_marks=True, mode="success", clients="all",
                  parts=("utm_source",))


def filtered_hits(hits: DataFrame, params: JobParams, variant: Variant) -> DataFrame:
    """Hits in the variant's time range, project, platforms, product and goal
    rule - all filters on raw hit columns, so they reach the scan."""
    lower = params.lookback_ms if variant.lookback else params.start_ms
    preds = [filters.time_range(lower, params.finish_ms),
             filters.project_is(params.project_id),
             filters.platform_in(params.source_platform),
             filters.product_is(params.product)]
    if not variant.keep_null_client:
        preds.append(F.col("ClientID").isNotNull())
    if variant.goal_rule == "drop_nontarget":
        preds.append(filters.goal_null_or_target(params.target_numbers))
    elif variant.goal_rule == "transit":
        preds.append(filters.goal_target_or_transit(params.target_numbers, goal_null_to_transit()))
    return filters.apply(hits, *preds)


def normalised_goal(params: JobParams, variant: Variant):
    if variant.goal_rule == "drop_nontarget":
        return goal_target_or_transit(params.target_numbers)
    return goal_null_to_transit()


def scope(hits: DataFrame, params: JobParams, variant: Variant) -> DataFrame:
    """Filtered hits as ClientID, HitTimeStamp, channel, goal, conv, qual, pre.

    ``conv`` cuts paths, ``qual`` marks a conversion that makes the client a
    converter (inside [start, finish)), ``pre`` a conversion before the start
    (the look-back cut; only for trimming variants).
    """
    df = filtered_hits(hits, params, variant)
    goal = normalised_goal(params, variant)
    ts, start = F.col("HitTimeStamp"), F.lit(params.start_ms)
    channel = channel_label() if variant.channel == "label" else utm_source_channel()
    if variant.goal_rule == "erase":
        # every hit in the window becomes a plain touch; target goals only
        # decide who converted
        conv = F.lit(False)
        qual = F.col("goal").isin(*params.target_numbers)
    else:
        conv = is_conversion(F.col("goal"))
        qual = conv & (ts >= start)
    pre = (conv & (ts < start)) if variant.trim else F.lit(False)
    return (df.select("ClientID", "HitTimeStamp", channel.alias("channel"), goal.alias("goal"))
            .select("ClientID", "HitTimeStamp", "channel", "goal",
                    conv.alias("conv"), qual.alias("qual"), pre.alias("pre")))
