"""The filter of kept clients: no client is lost, few others pass, and it stands below the hit shuffle."""
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitlog import hits_df, micro_rows
from pathfold import JobParams
from pathfold.operators import client_filter
from pathfold.operators.client_filter import only, useful_filter
from pathfold.operators.sequence import overview
from pathfold.plans import CANONICAL, V2, reports
from pathfold.plans.variants import scope

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5), source_platform=("ga",))
DDL = "ClientID string, HitTimeStamp bigint, channel string, conv boolean, qual boolean, pre boolean"


def _many(spark, n_clients=20_000, one_in=20):
    """Every client with 5 hits; one in ``one_in`` converts; and a null client."""
    client = F.when(F.col("id") % 9973 == 5, None).otherwise(F.concat(F.lit("c"), (F.col("id") % n_clients).cast("string")))
    conv = (F.col("id") < n_clients) & (F.col("id") % one_in == 0)
    return spark.range(5 * n_clients).select(client.alias("ClientID"), F.col("id").alias("HitTimeStamp"), F.lit("x").alias("channel"),
                                             conv.alias("conv"), conv.alias("qual"), F.lit(False).alias("pre"))


@pytest.mark.parametrize("clients,kept", [("converters", "qual"), ("nonconverters", "not qual")])
def test_kept_clients_pass_and_few_others(spark, clients, kept):
    hits = _many(spark, one_in=20 if clients == "converters" else 1)
    if clients == "nonconverters":  # most convert
        hits = hits.withColumn("qual", F.col("qual") & (F.xxhash64("ClientID") % 10 != 0))
    flags = hits.groupBy("ClientID").agg(F.max("qual").alias("qual"))
    seen = overview(hits, clients)
    assert seen.hits == hits.count() and seen.kept is not None
    assert seen.kept.words.num_rows <= flags.where(kept).count()
    passed = only(hits, seen.kept)
    assert passed.columns == hits.columns
    wanted = hits.join(flags.where(kept).select(F.col("ClientID").alias("k")), F.col("ClientID").eqNullSafe(F.col("k")), "left_semi")
    assert wanted.exceptAll(passed).count() == 0
    assert passed.count() <= wanted.count() + 0.01 * hits.count()


def test_no_filter_where_it_does_not_pay(spark):
    hits = _many(spark, 2000, 1)
    assert overview(hits, "converters").kept is None     # nearly all hits are kept
    assert overview(hits, "all").kept is None
    full = pa.table({"word": pa.array(range(client_filter.WORDS)), "bits": pa.array([(1 << 40) - 1] * client_filter.WORDS), "kept_hits": [1] * client_filter.WORDS})
    assert useful_filter(full, 1 << 40) is None
    assert useful_filter(full.slice(0, 1000), 1 << 40).words.num_rows == 1000


def test_an_empty_filter_keeps_nothing(spark):
    hits = _many(spark, 100, 1000).withColumn("qual", F.lit(False))
    seen = overview(hits, "converters")
    assert seen.kept is not None and seen.kept.words.num_rows == 0 and only(hits, seen.kept).count() == 0
    assert overview(hits.limit(0), "converters").hits == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_stands_below_the_hit_shuffle(spark, tmp_path):
    path = str(tmp_path / "hits")
    idle = [r[:1] + (f"idle{i}",) + r[2:11] + (None,) + r[12:] for i, r in enumerate(micro_rows() * 5)]  # goal is the 12th column
    hits_df(spark, micro_rows() + idle).write.parquet(path)
    hits = spark.read.parquet(path)
    for report in (reports.detail_report, reports.path_counts, reports.lookback_trim):
        plan = _plan(report(hits, PARAMS))
        shuffle, probe = plan.index("hashpartitioning(ClientID"), plan.index("LeftSemi")
        assert shuffle < probe < plan.index("FileScan"), plan
    assert "LeftSemi" not in _plan(reports.status_pivot(hits, PARAMS, V2))


def test_fewer_bytes_are_shuffled_and_rows_are_equal(spark, tmp_path, monkeypatch):
    """The written size of the hit shuffle, from the plan's own metrics after it ran."""
    path = str(tmp_path / "hits")
    idle = [r[:1] + (f"idle{i}",) + r[2:11] + (None,) + r[12:] for i, r in enumerate(micro_rows() * 300)]
    hits_df(spark, micro_rows() + idle).write.parquet(path)
    hits = spark.read.parquet(path)

    def ran():
        df = reports.detail_report(hits, PARAMS)
        rows = sorted(map(tuple, df.collect()))
        plan, sizes = df._jdf.queryExecution().executedPlan().finalPhysicalPlan(), []
        todo = [plan]
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange" and "hashpartitioning(ClientID" in node.toString():
                sizes.append(node.metrics().apply("shuffleBytesWritten").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName().startswith("ShuffleQueryStage"):
                todo.append(node.plan())
        return rows, max(sizes)

    rows, with_filter = ran()
    monkeypatch.setattr(client_filter, "WORTH", -1.0)
    same, without = ran()
    assert rows == same and rows and with_filter < 0.2 * without


def test_scoped_hits_of_the_micro_fixture(spark):
    scoped = scope(hits_df(spark, micro_rows()), PARAMS, CANONICAL)
    seen = overview(scoped, "converters")
    assert (seen.hits, seen.most) == (scoped.count(), 7)
