"""Results must not depend on the session time zone."""
import os

import pytest
from pyspark.sql import functions as F

from pathfold.functions import local_midnight_ms
from pathfold.sources import hits_from_events

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_event_hits_and_midnights_ignore_session_zone(spark):
    def snapshot():
        hits = hits_from_events(spark, SF).select(F.sum("HitTimeStamp").alias("s")).first().s
        day = spark.range(1).select(local_midnight_ms(F.lit("2019-01-01")).alias("m")).first().m
        return hits, day
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        utc = snapshot()
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = snapshot()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc == ny
    assert utc[1] == 1546290000000
