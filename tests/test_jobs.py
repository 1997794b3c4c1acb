"""The path job as a whole: stages that a rerun takes up, diagnostics without a scan of their own."""
import pytest
from pyspark.sql import functions as F

from hitlog import hit, hits_df, letters, micro_rows
from pathfold import JobParams
from pathfold.operators.sequence import overview
from pathfold.plans import CANONICAL, NULL, V3, jobs, reports
from pathfold.plans.staging import Stages, job_key
from pathfold.session import path_exists


@pytest.fixture()
def params(spark, tmp_path):
    log = str(tmp_path / "log")
    hits_df(spark, micro_rows()).write.parquet(log)
    return JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5), source_platform=("ga",),
                     flat_path=(log,), output_path=str(tmp_path / "agg"), output_path_detail=str(tmp_path / "detail"))


def _agg(spark, params):
    rows = spark.read.option("header", "true").schema("user_path string, count bigint").csv(params.output_path).collect()
    return sorted((letters(r.user_path), r["count"]) for r in rows)


AGG = [("A", 2), ("B", 1), ("B=>C=>D", 1), ("C", 1), ("E=>F", 1)]


def _failing(at):
    """write_csv, the ``at``-th call of which fails."""
    calls = []

    def write(df, path, **how):
        calls.append(path)
        if len(calls) == at:
            raise OSError("disk full")
        real(df, path, **how)

    real = jobs.write_csv
    return write, calls


def _folder(spark, params, variant=CANONICAL):
    from pathfold.sources import read_hits
    return Stages(spark, job_key(read_hits(spark, params.flat_path, needed=variant.needed(params)), params, variant, False, False)).folder


def test_a_rerun_takes_up_what_is_finished(spark, params, monkeypatch):
    write, calls = _failing(2)
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_csv", write)
        with pytest.raises(OSError):
            jobs.path_reports(spark, params)
    assert calls == [params.output_path_detail, params.output_path]
    assert path_exists(spark, _folder(spark, params)) and not path_exists(spark, params.output_path)

    def never(*_, **__):
        raise AssertionError("done before")

    write, calls = _failing(0)
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_csv", write)
        m.setattr(reports, "detail_report", never)
        m.setattr(reports, "job_overview", never)
        told = jobs.path_reports(spark, params)
    assert calls == [params.output_path] and _agg(spark, params) == AGG
    assert {r.goal: r["count"] for r in told["goal_counts"].collect()} == {-1: 9, 3: 8, 5: 1}
    assert not path_exists(spark, _folder(spark, params))  # the job is done


def test_an_unfinished_table_is_written_again(spark, params, monkeypatch):
    write, _ = _failing(1)
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_csv", write)
        with pytest.raises(OSError):
            jobs.path_reports(spark, params)
    stages = Stages(spark, _folder(spark, params).rsplit("job-", 1)[1])
    assert stages.finished("detail")
    # as if the run had ended in the middle of the table
    spark.range(5).write.mode("overwrite").parquet(f"{stages.folder}/detail")
    from pathfold.session import delete_folder
    delete_folder(spark, stages._marker("detail"))
    jobs.path_reports(spark, params)
    assert _agg(spark, params) == AGG


def test_another_log_or_another_report_is_another_job(spark, params, tmp_path):
    from pathfold.sources import read_hits
    hits = read_hits(spark, params.flat_path)
    assert job_key(hits, params, CANONICAL) == job_key(read_hits(spark, params.flat_path), params, CANONICAL)
    assert job_key(hits, params, V3) != job_key(hits, params, CANONICAL)
    hits.limit(1).write.mode("append").parquet(params.flat_path[0])
    assert job_key(read_hits(spark, params.flat_path), params, CANONICAL) != job_key(hits, params, CANONICAL)
    frame = hits_df(spark, micro_rows())
    assert job_key(frame, params) != job_key(frame, params)


@pytest.mark.parametrize("variant", [CANONICAL, V3, NULL], ids=lambda v: v.name)
@pytest.mark.parametrize("mode", ["true", "false"])
def test_diagnostics_are_those_of_the_reports(spark, params, variant, mode):
    p = JobParams(**{**params.__dict__, "achieve_mode": mode})
    rows = micro_rows() + [hit(None, "A", 120, 5), hit(None, "A", 121, 7), hit("c9", "A", 122, 7)]
    hits = hits_df(spark, rows, 3)
    told = jobs.path_reports(spark, p, variant, hits=hits)
    for name, report in (("goal_counts", reports.goal_counts), ("conversion_counts", reports.conversion_counts)):
        assert sorted(map(str, told[name].collect())) == sorted(map(str, report(hits, p, variant).collect())), name


def test_a_goal_only_of_the_null_client_is_there_with_no_hits(spark, params):
    hits = hits_df(spark, [hit(None, "A", 120, 5), hit("a", "B", 130, 3)])
    told = jobs.path_reports(spark, params, hits=hits)
    assert {r.goal: r["count"] for r in told["goal_counts"].collect()} == {3: 1, 5: 0}


def test_diagnostics_scan_nothing(spark, params):
    told = jobs.path_reports(spark, params)
    for df in told.values():
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()


def test_the_overview_leaves_the_null_client_out_if_it_is_none(spark):
    rows = [(None, 5, False), (None, 6, True), ("a", 7, True), ("a", 8, False)]
    hits = spark.createDataFrame(rows, "ClientID string, HitTimeStamp bigint, conv boolean").selectExpr(
        "*", "conv as qual", "false as pre", "cast(if(conv, 3, -1) as bigint) as goal")
    for null_is_client, want in ((True, (4, 2, 2, 4, 2)), (False, (2, 2, 1, 2, 1))):
        seen = overview(hits, "converters", (3, 5), null_is_client)
        assert (seen.hits, seen.most, seen.n_conv, seen.kept_hits, seen.kept_conv) == want
        assert seen.goals == {3: (2, 1), 5: (0, 0)}


def test_numbered_channels_and_slots_in_the_job(spark, params):
    p = JobParams(**{**params.__dict__, "channel_numbers": True, "heavy_share": 1000, "heavy_rows": 1})
    jobs.path_reports(spark, p)
    assert _agg(spark, p) == AGG
    detail = spark.read.option("header", "true").csv(p.output_path_detail)
    assert detail.count() == 6 and detail.where(F.col("target_numbers") == "3,5").count() == 6
