"""Physical-plan properties the design relies on, read off physical plans."""
import re

from hitlog import hits_df, micro_rows
from pathfold import JobParams
from pathfold.plans import NULL, V2, reports
from pathfold.sources import read_hits

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0,
                   target_numbers=(3, 5), source_platform=("ga",))


def _plan(df) -> str:
    """The physical plan before adaptive execution changes it at run time."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated scan metadata
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _hits(spark, tmp_path):
    path = str(tmp_path / "hits")
    hits_df(spark, micro_rows()).write.parquet(path)
    return read_hits(spark, path)


def test_filters_and_pruning_reach_the_parquet_reader(spark, tmp_path):
    plan = _plan(reports.detail_report(_hits(spark, tmp_path), PARAMS))
    pushed = " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", plan))
    for needle in ("HitTimeStamp", "ProjectID", "src", "goal"):
        assert needle in pushed, (needle, pushed)
    assert "In(src, [ga])" in pushed or "EqualTo(src,ga)" in pushed, pushed
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    # no product asked: ga_location is never read
    assert all("ga_location" not in s for s in schemas)


def test_scans(spark, tmp_path):
    """One scan to find heavy clients (run beforehand), and one for the report."""
    hits = _hits(spark, tmp_path)
    for df in (reports.path_counts(hits, PARAMS), reports.status_pivot(hits, PARAMS, V2), reports.detail_report(hits, PARAMS)):
        assert _plan(df).count("ReadSchema") == 1


def test_no_python_udf_no_cartesian_product(spark, tmp_path):
    hits = _hits(spark, tmp_path)
    for df in (reports.detail_report(hits, PARAMS), reports.status_pivot(hits, PARAMS, V2),
               reports.client_sequences(hits, PARAMS)):
        plan = _plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                    "FlatMapGroupsInPandas"):
            assert bad not in plan, bad


def test_hits_shuffle_once_on_the_client(spark, tmp_path):
    plan = _plan(reports.detail_report(_hits(spark, tmp_path), PARAMS))
    assert re.findall(r"hashpartitioning\(([^,]*)#", plan) == ["ClientID"], plan


def test_unkept_clients_go_before_text_is_collected(spark, tmp_path):
    """Conditions on a client's totals and the segment stand between window and collect."""
    hits = _hits(spark, tmp_path)
    fail = JobParams(**{**PARAMS.__dict__, "achieve_mode": "false"})
    for df in (reports.path_counts(hits, fail), reports.path_counts(hits, PARAMS, NULL)):
        plan = _plan(df)
        assert plan.index("collect_list") < plan.index("client_qual") < plan.index("Window [")
        assert re.search(r"Filter .*client_qual#\d+L? = 0", plan), plan


def test_count_reports_build_no_timelines(spark, tmp_path):
    hits = _hits(spark, tmp_path)
    for df in (reports.path_counts(hits, PARAMS), reports.status_pivot(hits, PARAMS, V2)):
        plan = _plan(df)
        assert "cast(HitTimeStamp" not in plan
    assert "cast(HitTimeStamp" in _plan(reports.detail_report(hits, PARAMS))
