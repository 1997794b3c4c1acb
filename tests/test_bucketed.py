"""The hit log by client: no hit shuffle in the reports over it, and a hot bucket read apart."""
import uuid

import pytest
from pyspark.sql import functions as F

from hitlog import hit, hits_df, micro_rows
from pathfold import JobParams
from pathfold.plans import V2, reports
from pathfold.sources import read_bucketed_hits, write_bucketed_hits
from pathfold.sources.bucketed import bucket_sizes

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5), source_platform=("ga",))


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _table(spark, tmp_path, hits, buckets=4, **how):
    name = f"log_{uuid.uuid4().hex}"
    write_bucketed_hits(hits, name, str(tmp_path / name), buckets, **how)
    return name


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_the_same(spark, tmp_path):
    hits = hits_df(spark, micro_rows(), 3).withColumn("other", F.lit(1))
    name = _table(spark, tmp_path, hits)
    back = read_bucketed_hits(spark, name)
    assert back.columns == hits.columns[:-1]
    assert sorted(map(str, back.collect())) == sorted(map(str, hits.drop("other").collect()))
    write_bucketed_hits(hits.limit(5), name, str(tmp_path / name), 4, mode="overwrite")
    assert read_bucketed_hits(spark, name).count() == 5


def test_two_reports_shuffle_no_hits(spark, tmp_path, no_broadcast):
    log = read_bucketed_hits(spark, _table(spark, tmp_path, hits_df(spark, micro_rows(), 3)))
    plain = hits_df(spark, micro_rows())
    for report, shuffles in ((lambda h: reports.detail_report(h, PARAMS), 0), (lambda h: reports.path_counts(h, PARAMS), 2),
                             (lambda h: reports.status_pivot(h, PARAMS, V2), 2), (lambda h: reports.client_sequences(h, PARAMS), 0)):
        plan = _plan(report(log))
        assert "Bucketed: true" in plan and "hashpartitioning(ClientID" not in plan, plan
        assert plan.count("Exchange") - plan.count("BroadcastExchange") == shuffles, plan  # of paths: by path, and for the order
        assert sorted(map(str, report(log).collect())) == sorted(map(str, report(plain).collect()))


def test_client_sets_shuffle_nothing(spark, tmp_path, no_broadcast):
    from pathfold.operators import clients
    from pathfold.plans import CANONICAL
    from pathfold.plans.variants import scope
    scoped = scope(read_bucketed_hits(spark, _table(spark, tmp_path, hits_df(spark, micro_rows(), 3))), PARAMS, CANONICAL)
    for sets in (clients.converters, clients.nonconverters, clients.converter_hits, clients.nonconverter_hits):
        assert "Exchange" not in _plan(sets(scoped)), sets


def test_a_hot_bucket_is_written_by_many_and_read_without_buckets(spark, tmp_path):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, "bot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("ClientID"),
                                      F.col("id").alias("HitTimeStamp"), F.sha2(F.col("id").cast("string"), 256).alias("utm_source"))
    base = hits_df(spark, [hit("x", "A", 1)])
    hits = rows.select(*[F.col(c) if c in rows.columns else F.lit(base.first()[c]).cast(base.schema[c].dataType).alias(c) for c in base.columns])
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        name = _table(spark, tmp_path, hits, 8)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    sizes = bucket_sizes(spark, str(tmp_path / name))
    files = len([f for f in (tmp_path / name).iterdir() if f.name.endswith(".parquet")])
    assert max(sizes.values()) > 3 * sorted(sizes.values())[4] and files > len(sizes)  # the hot one is several files
    whole, apart = read_bucketed_hits(spark, name), read_bucketed_hits(spark, name, uneven=2.0, least_bytes=1000)
    assert "Bucketed: true" in _plan(whole.groupBy("ClientID").count()) and "Bucketed: true" not in _plan(apart.groupBy("ClientID").count())
    assert whole.exceptAll(apart).count() == 0 and apart.count() == 60_000


def test_other_tables_are_refused(spark, tmp_path):
    name = f"log_{uuid.uuid4().hex}"
    hits_df(spark, micro_rows()).write.option("path", str(tmp_path / name)).saveAsTable(name)
    with pytest.raises(ValueError, match="not bucketed"):
        read_bucketed_hits(spark, name)
    with pytest.raises(ValueError, match="positive"):
        write_bucketed_hits(hits_df(spark, micro_rows()), name, str(tmp_path / "x"), 0)
