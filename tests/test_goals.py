"""Goal rules, conversion marks and touch records."""
from pyspark.sql import functions as F

from pathfold.functions import (conversion_mark, goal_null_to_transit, goal_target_or_transit,
                                tagged_touch, touch_map)


def _df(spark):
    return spark.createDataFrame([(None, 10), (3, 11), (5, 12), (7, 13), (-1, 14)],
                                 "goal bigint, HitTimeStamp bigint")


def test_goal_rules(spark):
    rows = _df(spark).select(goal_target_or_transit([3, 5]).alias("a"),
                             goal_null_to_transit().alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(-1, -1), (3, 3), (5, 5), (-1, 7), (-1, -1)]


def test_marks_and_tags(spark):
    df = spark.createDataFrame([("A", True, 1), ("B", False, 2)], "channel string, conv boolean, HitTimeStamp bigint")
    rows = df.select(conversion_mark(F.col("conv")).alias("m"),
                     conversion_mark(F.col("conv"), old_style=True).alias("old"),
                     tagged_touch(F.col("channel"), F.col("conv")).alias("tag"),
                     tagged_touch(F.col("channel"), F.col("conv"), old_style=True).alias("old_tag"),
                     touch_map(tagged_touch(F.col("channel"), F.col("conv"))).alias("touch")).collect()
    assert [(r.m, r.old, r.tag, r.old_tag, r.touch) for r in rows] == [
        ("get@conv", "1", "A::_get@conv", "A_1", {"A::_get@conv": 1}),
        ("get@no_conv", "0", "B::_get@no_conv", "B_0", {"B::_get@no_conv": 2})]
