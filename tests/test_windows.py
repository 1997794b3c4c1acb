"""Reports by window: a rerun of one window leaves the others alone."""
import glob
import os

import pytest

from hitlog import hits_df, letters, micro_rows
from pathfold import JobParams
from pathfold.plans import jobs, reports
from pathfold.sinks import write_window

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5), source_platform=("ga",))


def _bytes(path):
    return {f: (open(f, "rb").read(), os.stat(f).st_mtime_ns) for f in glob.glob(f"{path}/report_window=*/*")}


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_rerunning_a_window_leaves_the_others_alone(spark, tmp_path, file_format):
    path, hits = str(tmp_path / "report"), hits_df(spark, micro_rows())
    other = JobParams(**{**PARAMS.__dict__, "date_finish": 125})
    write_window(reports.path_counts(hits, PARAMS), path, "100_200", file_format)
    write_window(reports.path_counts(hits, other), path, "100_125", file_format)
    before = _bytes(path)
    write_window(reports.path_counts(hits.where("ClientID <> 'c4'"), other), path, "100_125", file_format)
    after = _bytes(path)
    kept = {f for f in before if "100_200" in f}
    assert kept and {f: after[f] for f in kept} == {f: before[f] for f in kept}
    assert not {f for f in before if "100_125" in f and f.endswith(file_format)} & set(after)  # replaced
    reader = spark.read.option("header", "true").schema("user_path string, count bigint, report_window string")
    rows = sorted((r.report_window, letters(r.user_path), r["count"]) for r in reader.format(file_format).load(path).collect())
    assert rows == [("100_125", "B", 1), ("100_125", "B=>C=>D", 1)] + [
        ("100_200", *x) for x in [("A", 2), ("B", 1), ("B=>C=>D", 1), ("C", 1), ("E=>F", 1)]]


def test_files_are_bounded_and_sorted_reports_stay_sorted(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = spark.range(1000).selectExpr("cast(id % 7 as string) as user_path", "id as count").orderBy("count")
    write_window(rows, path, "w", most_rows=100, keep_order=True)
    files = sorted(glob.glob(f"{path}/report_window=w/*.csv"))
    lines = [open(f).read().splitlines()[1:] for f in files]
    assert max(map(len, lines)) <= 100 and [int(x.split(",")[1]) for part in lines for x in part] == list(range(1000))


def test_names_that_are_no_window(spark, tmp_path):
    for df, window in ((spark.range(1), ""), (spark.range(1), "a/b"), (spark.range(1).selectExpr("id as report_window"), "w")):
        with pytest.raises(ValueError):
            write_window(df, str(tmp_path / "x"), window)


def test_the_path_job_by_window(spark, tmp_path):
    hits = hits_df(spark, micro_rows())
    outputs = {"output_path": str(tmp_path / "agg"), "output_path_detail": str(tmp_path / "detail")}
    for finish in (200, 125, 200):
        jobs.path_reports(spark, JobParams(**{**PARAMS.__dict__, **outputs, "date_finish": finish}), hits=hits, by_window=True)
    for path, n in ((outputs["output_path"], {"100_200": 5, "100_125": 3}), (outputs["output_path_detail"], {"100_200": 6, "100_125": 4})):
        got = spark.read.option("header", "true").csv(path).groupBy("report_window").count().collect()
        assert {r.report_window: r["count"] for r in got} == n
