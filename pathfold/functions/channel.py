"""Channel labels: the indivisible unit a path is made of.

Built-in column expressions only, so the label is computed inside
whole-stage codegen right after the scan.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import INTERACTION_TYPES, NULL_TEXT, SEIZMIK_CHANNEL


def _part(name: str) -> Column:
    # a missing part renders as the text 'null' (string '+' semantics);
    # plain concat would null the whole label, concat_ws would skip the part
    return F.coalesce(F.col(name), F.lit(NULL_TEXT))


def _ad_label(last_part: str) -> Column:
    return F.concat(F.col("interaction_type"), F.lit(":"), _part("utm_source"), F.lit(" / "),
                    _part("utm_medium"), F.lit(" / "), _part("utm_campaign"), F.lit(":"),
                    _part(last_part))


def channel_label() -> Column:
    """Channel of a hit from its platform (``src``) and the utm parts.

    adriver / dcm view|click -> ``<type>:<source> / <medium> / <campaign>:<profile|placement>``;
    seizmik -> a constant; ga / bq -> ``<sourcemedium> / <campaign>``.
    Any other platform, or an adriver / dcm hit of another interaction type,
    fails the job (``raise_error`` only fires for rows that reach it).
    """
    src, itype = F.col("src"), F.col("interaction_type")
    ad_touch = itype.isin(*INTERACTION_TYPES)
    return (
        F.when((src == "adriver") & ad_touch, _ad_label("profile"))
        .when((src == "dcm") & ad_touch, _ad_label("dcm_placement_id"))
        .when(src == "seizmik", F.lit(SEIZMIK_CHANNEL))
        .when(src.isin("ga", "bq"), F.concat(_part("ga_sourcemedium"), F.lit(" / "), _part("utm_campaign")))
        .otherwise(F.raise_error(F.concat(
            F.lit("Unknown data source: src="), F.coalesce(src, F.lit(NULL_TEXT)),
            F.lit(", interaction_type="), F.coalesce(itype, F.lit(NULL_TEXT)))))
    )


def utm_source_channel() -> Column:
    """CSV-era channel: the utm source alone, 'null' when missing."""
    return _part("utm_source")
