"""Channel label cases."""
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hitlog import HIT_DDL, hit
from pathfold.functions import channel_label, utm_source_channel


def label(spark, **kw):
    parts = dict(utm_source="s", utm_medium="m", utm_campaign="c", profile="p", dcm_placement_id="pl")
    row = hit("c", "SM", 1, **{**parts, **kw})
    return spark.createDataFrame([row], HIT_DDL).select(channel_label().alias("ch")).first().ch


@pytest.mark.parametrize("kw,expected", [
    (dict(src="adriver", interaction_type="view"), "view:s / m / c:p"),
    (dict(src="adriver", interaction_type="click"), "click:s / m / c:p"),
    (dict(src="dcm", interaction_type="click"), "click:s / m / c:pl"),
    (dict(src="dcm", interaction_type="view"), "view:s / m / c:pl"),
    (dict(src="seizmik"), "seizmik_channel"),
    (dict(src="ga"), "SM / c"),
    (dict(src="bq"), "SM / c"),
    (dict(src="ga", utm_campaign=None), "SM / null"),
    (dict(src="adriver", interaction_type="view", utm_medium=None), "view:s / null / c:p"),
    (dict(src="adriver", interaction_type="view", profile=None), "view:s / m / c:null"),
])
def test_channel_cases(spark, kw, expected):
    assert label(spark, **kw) == expected


@pytest.mark.parametrize("kw", [
    dict(src="adriver", interaction_type=None),
    dict(src="adriver", interaction_type="other"),
    dict(src="dcm", interaction_type="other"),
    dict(src="foo"),
])
def test_unknown_source_fails(spark, kw):
    with pytest.raises(PySparkException, match="Unknown data source"):
        label(spark, **kw)


def test_error_only_for_rows_that_reach_it(spark):
    rows = [hit("c", "A", 1, src="ga"), hit("c", "B", 2, src="foo")]
    df = spark.createDataFrame(rows, HIT_DDL).filter(F.col("src") == "ga")
    assert [r.ch for r in df.select(channel_label().alias("ch")).collect()] == ["A / x"]


def test_utm_source_channel(spark):
    rows = [hit("c", "A", 1, utm_source="u1"), hit("c", "B", 2, utm_source=None)]
    df = spark.createDataFrame(rows, HIT_DDL).select(utm_source_channel().alias("ch"))
    assert sorted(r.ch for r in df.collect()) == ["null", "u1"]
