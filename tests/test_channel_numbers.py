"""Channels and paths as numbers: the same reports, and no path text where paths are shuffled."""
import re

import pytest
from pyspark.sql import functions as F

from hitlog import hit, hits_df, micro_rows
from pathfold import JobParams
from pathfold.operators import ChannelNumbers, channel_numbers
from pathfold.plans import CANONICAL, CSV_ERA, NULL, V2, V3, reports
from pathfold.plans.variants import scope

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5), source_platform=("ga",))
NUMBERED = JobParams(**{**PARAMS.__dict__, "channel_numbers": True})
#: channels whose order as text and byte by byte is easily taken wrong
ODD = ["A", "A ", "a", "Ä", "=>", "A=>B", "\u001f", "\"", "\\", "日本", "🙂", "￿", ""]


def _rows(df):
    return sorted(map(str, df.collect()))


def _hits(spark):
    odd = [hit(f"o{i % 4}", c, 110 + i // 7, 3 if i % 5 == 0 else None) for i, c in enumerate(ODD * 6)]
    return hits_df(spark, micro_rows() + odd, 3)


@pytest.mark.parametrize("split", [{}, {"heavy_share": 1000, "heavy_rows": 1}])
@pytest.mark.parametrize("variant", [CANONICAL, V3, NULL, V2, CSV_ERA], ids=lambda v: v.name)
def test_reports_are_the_same(spark, variant, split):
    hits = _hits(spark)
    plain, numbered = (JobParams(**{**p.__dict__, **split}) for p in (PARAMS, NUMBERED))
    for report in (reports.detail_report, reports.path_counts):
        assert _rows(report(hits, numbered, variant)) == _rows(report(hits, plain, variant))
    if variant in (V2, CSV_ERA):
        assert reports.status_pivot(hits, numbered, variant).collect() == reports.status_pivot(hits, plain, variant).collect()
        assert reports.top_paths(hits, numbered, 5, variant).collect() == reports.top_paths(hits, plain, 5, variant).collect()


def test_numbers_are_in_the_order_of_the_texts(spark):
    texts = spark.createDataFrame([(c,) for c in ODD], "channel string")
    names = channel_numbers(texts).names
    assert list(names) == [r.channel for r in texts.orderBy("channel").collect()]
    path = spark.createDataFrame([(list(range(len(names))),), ([],), ([0, None],)], "p array<int>")
    assert [r[0] for r in path.select(ChannelNumbers(names).text(F.col("p"))).collect()] == ["=>".join(names), "", names[0]]


def test_no_text_is_shuffled_with_paths_or_hits(spark, tmp_path):
    path = str(tmp_path / "hits")
    hits_df(spark, micro_rows()).write.parquet(path)
    hits = spark.read.parquet(path)
    for report, column in ((reports.path_counts, "user_path"), (lambda h, p: reports.status_pivot(h, p, V2), "paths")):
        df = report(hits, NUMBERED)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan  # the list is a literal, parsed once
        by_path = plan.index(f"hashpartitioning({'user_path' if column == 'user_path' else ''}")
        below = plan[by_path:plan.index("FileScan")]
        assert "array_join" not in below and "number" in below  # text is made above the paths' exchange
        hit_shuffle = below[below.index("hashpartitioning(ClientID"):]
        output = re.search(r"Project \[([^\n]*)\]", hit_shuffle).group(1)
        number = re.search(r"number#\d+[^\n]* AS (channel#\d+)", hit_shuffle).group(1)
        assert number in output, output  # hits are shuffled with the number


def test_too_many_or_too_long_channels_keep_their_text(spark):
    scoped = spark.range(100).select(F.concat(F.lit("c"), F.col("id")).alias("channel"))
    assert len(channel_numbers(scoped).names) == 100 and len(channel_numbers(scoped, 100).names) == 100
    assert channel_numbers(scoped, 99) is None
    assert channel_numbers(scoped, 1000, 289) is None and channel_numbers(scoped, 1000, 290) is not None
    assert channel_numbers(scoped.select(F.repeat("channel", 1000).alias("channel")), 1000, 2500) is None
    assert channel_numbers(scoped.where("false")).names == ()
    assert channel_numbers(scoped.select(F.lit(None).cast("string").alias("channel"))).names == ()


def test_a_channel_that_is_not_listed_fails(spark):
    scoped = scope(hits_df(spark, micro_rows()), PARAMS, CANONICAL)
    numbers = channel_numbers(scoped)
    assert set(numbers.numbered(scoped).select("channel").distinct().toPandas()["channel"]) == set(range(len(numbers.names)))
    with pytest.raises(Exception, match="lacks"):
        ChannelNumbers(numbers.names[1:]).numbered(scoped).collect()
