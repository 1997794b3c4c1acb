"""Sources and sinks: parquet with merged / legacy schemas, CSV, JSON config, job outputs."""
import datetime
import glob
import re
import json
import os

import pytest
from hitlog import hits_df, letters, micro_rows
from pathfold import JobParams
from pyspark.sql import functions as F
from pathfold.plans import V3, jobs
from pathfold.sinks import write_csv
from pathfold.sources import read_config, read_csv_hits, read_hits


def test_parquet_merged_and_legacy_schema(spark, tmp_path):
    named = lambda rows: hits_df(spark, rows).withColumns({"interaction_type": F.lit("click"), "profile": F.lit("p")})
    new = named(micro_rows()[:3])
    new.write.parquet(str(tmp_path / "new"))
    legacy = (named(micro_rows()[3:5])
              .withColumnRenamed("interaction_type", "adr_typenum")
              .withColumnRenamed("profile", "adr_profile").drop("dcm_placement_id"))
    legacy.write.parquet(str(tmp_path / "old"))
    df = read_hits(spark, f"{tmp_path / 'new'}, {tmp_path / 'old'}")
    assert df.count() == 5
    assert [f.name for f in df.schema.fields][:3] == ["ProjectID", "ClientID", "HitTimeStamp"]
    # every file's values, whatever its columns are called
    assert df.where("interaction_type = 'click' and profile = 'p'").count() == 5
    only_old = read_hits(spark, [str(tmp_path / "old")])
    assert only_old.filter("dcm_placement_id IS NULL").count() == 2


def test_bad_values_become_null(spark, tmp_path):
    spark.createDataFrame([("x1", "c", "12", "abc", "ga")],
                          "ProjectID string, ClientID string, HitTimeStamp string, goal string, src string") \
        .write.parquet(str(tmp_path / "raw"))
    row = read_hits(spark, str(tmp_path / "raw")).first()
    assert row.ProjectID is None and row.HitTimeStamp == 12 and row.goal is None


def test_csv_source(spark, tmp_path):
    path = str(tmp_path / "log.csv")
    with open(path, "w") as f:
        f.write("ProjectID;ClientID;HitTimeStamp;ga_sourcemedium;utm_source;ga_location;goal;src\n")
        f.write("1;c1;110;g / m;u1;p1;3;ga\n1;c1;120;g / m;;p1;;ga\n")
    rows = read_csv_hits(spark, path).orderBy("HitTimeStamp").collect()
    assert [(r.ClientID, r.HitTimeStamp, r.utm_source, r.goal) for r in rows] == [
        ("c1", 110, "u1", 3), ("c1", 120, None, None)]


def test_csv_source_reads_columns_by_header_name(spark, tmp_path):
    path = str(tmp_path / "log2.csv")
    with open(path, "w") as f:
        f.write("src;goal;ClientID;HitTimeStamp;ProjectID;utm_source\n")
        f.write("ga;5;c2;130;1;u2\nbq;x;c2;140;1;u3\n")
    rows = read_csv_hits(spark, path).orderBy("HitTimeStamp").collect()
    assert [(r.ProjectID, r.ClientID, r.HitTimeStamp, r.goal, r.src, r.utm_source, r.ga_location)
            for r in rows] == [(1, "c2", 130, 5, "ga", "u2", None), (1, "c2", 140, None, "bq", "u3", None)]


def test_csv_logs_of_different_column_order(spark, tmp_path):
    (tmp_path / "both").mkdir()
    for name, header, line in (("a.csv", "ProjectID;ClientID;HitTimeStamp;goal;src;utm_source", "1;c1;110;3;ga;u1"),
                               ("b.csv", "src;goal;ClientID;HitTimeStamp;ProjectID;utm_source", "bq;5;c2;130;1;u2")):
        for folder in (tmp_path, tmp_path / "both"):
            (folder / name).write_text(f"{header}\n{line}\n")
    rows = read_csv_hits(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).orderBy("HitTimeStamp").collect()
    assert [(r.ProjectID, r.ClientID, r.HitTimeStamp, r.goal, r.src) for r in rows] == [
        (1, "c1", 110, 3, "ga"), (1, "c2", 130, 5, "bq")]
    with pytest.raises(Exception, match="header"):  # one folder: refused, not misread
        read_csv_hits(spark, str(tmp_path / "both")).collect()


@pytest.mark.parametrize("lacking", ["src", "goal", "ClientID", "HitTimeStamp", "ProjectID"])
def test_a_log_without_a_key_column_is_refused(spark, tmp_path, lacking):
    path = str(tmp_path / "log")
    hits_df(spark, micro_rows()).drop(lacking).write.parquet(path)
    with pytest.raises(ValueError, match=lacking):
        read_hits(spark, path)


def test_a_report_refuses_a_log_without_its_channel_parts(spark, tmp_path):
    path = str(tmp_path / "log")
    hits_df(spark, micro_rows()).drop("dcm_placement_id").write.parquet(path)
    p = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5),
                  source_platform=("ga",), flat_path=(path,), output_path=str(tmp_path / "agg"),
                  output_path_detail=str(tmp_path / "detail"))
    with pytest.raises(ValueError, match="dcm_placement_id"):
        jobs.path_reports(spark, p)
    jobs.path_reports(spark, p, V3)  # older logs have no placement


def test_blanks_around_a_channel_survive_the_csv(spark, tmp_path):
    write_csv(spark.createDataFrame([(" a ", 1)], "user_path string, n int"), str(tmp_path / "o"))
    assert " a ,1" in _csv_rows(str(tmp_path / "o"))[1]


def test_day_partitions_without_a_day_and_in_another_format(spark, tmp_path):
    day = F.date_format(F.timestamp_millis("HitTimeStamp"), "yyyyMMdd")
    log = str(tmp_path / "days")
    hits = hits_df(spark, micro_rows())
    hits.withColumn("dt", F.when(F.col("HitTimeStamp") % 20 == 0, None).otherwise(day)).write.partitionBy("dt").parquet(log)
    days = (datetime.date(1969, 12, 31), datetime.date(1970, 1, 2))
    assert read_hits(spark, log, day_column="dt", days=days, day_format="yyyyMMdd").count() == hits.count()
    later = (datetime.date(1970, 1, 5), datetime.date(1970, 1, 6))
    assert read_hits(spark, log, day_column="dt", days=later, day_format="yyyyMMdd").count() == \
        hits.where("HitTimeStamp % 20 = 0").count()
    known = hits.withColumn("dt", F.lit("x")).schema
    assert read_hits(spark, log, day_column="dt", days=days, day_format="yyyyMMdd", schema=known).count() == hits.count()


def test_json_config(spark, tmp_path):
    path = str(tmp_path / "params.json")
    with open(path, "w") as f:
        json.dump({"projectID": 77, "date_start": "2021-06-07", "date_finish": "2021-06-21",
                   "target_numbers": [11, 40], "product_name": None,
                   "source_platform": ["dcm", "bq"], "flat_path": "/logs/june.csv",
                   "output_path": "/reports/"}, f)
    p = read_config(spark, path)
    assert p.project_id == 77 and p.target_numbers == (11, 40) and p.product is None
    assert p.source_platform == ("dcm", "bq") and p.flat_path == ("/logs/june.csv",)
    assert p.start_ms == 1623013200000  # midnight in Moscow
    assert read_config(spark, path, zone="UTC").start_ms == p.start_ms + 3 * 3_600_000


def _csv_rows(path):
    files = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    lines = []
    for fn in files:
        with open(fn) as f:
            lines += f.read().splitlines()
    return files, lines


def test_path_job_writes_reports(spark, tmp_path):
    src = str(tmp_path / "hits")
    hits_df(spark, micro_rows()).write.parquet(src)
    p = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5),
                  source_platform=("ga",), flat_path=(src,), output_path=str(tmp_path / "agg"),
                  output_path_detail=str(tmp_path / "detail"))
    diag = jobs.path_reports(spark, p, single_file=True)
    assert {r.goal: r["count"] for r in diag["goal_counts"].collect()} == {-1: 9, 3: 8, 5: 1}
    files, lines = _csv_rows(str(tmp_path / "agg"))
    assert len(files) == 1
    assert [letters(x) for x in lines] == ["user_path,count", "A,2", "B,1", "B=>C=>D,1", "C,1", "E=>F,1"]
    _, detail = _csv_rows(str(tmp_path / "detail"))
    body = sorted(x for x in detail if not x.startswith("ClientID"))
    assert len(body) == 6 and all(x.endswith(',"3,5"') for x in body)


def test_pivot_job_writes_one_named_file(spark, tmp_path):
    src = str(tmp_path / "hits")
    hits_df(spark, micro_rows()).write.parquet(src)
    p = JobParams(project_id=1, date_start=100, date_finish=200, target_numbers=(3, 5),
                  source_platform=("ga",), flat_path=(src,), output_path=str(tmp_path) + "/",
                  product_name="null")
    out = jobs.pivot_report(spark, p, single_file=True)
    assert out.endswith("1_100_200_null_3;5")
    files, lines = _csv_rows(out)
    assert len(files) == 1 and lines[0] == "paths,true,false,share"
    assert letters(lines[1]).startswith("A,3,,0.428")


def test_parallel_reports_keep_order(spark, tmp_path):
    src = str(tmp_path / "hits")
    hits_df(spark, micro_rows()).write.parquet(src)
    p = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0, target_numbers=(3, 5),
                  source_platform=("ga",), flat_path=(src,), output_path=str(tmp_path / "agg"),
                  output_path_detail=str(tmp_path / "detail"))
    jobs.path_reports(spark, p)
    _, lines = _csv_rows(str(tmp_path / "agg"))
    body = [letters(x) for x in lines if x != "user_path,count"]
    assert body == ["A,2", "B,1", "B=>C=>D,1", "C,1", "E=>F,1"]


def test_cli_paths_end_to_end(spark, tmp_path):
    """spark-submit style run over a parquet hit log: the 216 converting paths
    of sf0.001 (FIXTURES.md section 3)."""
    from pathfold import cli
    from pathfold.sources import hits_from_events
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test data not present")
    log = str(tmp_path / "log")
    hits_from_events(spark, sf).write.parquet(log)
    args = ["paths", "--projectID=3", "--date_start=2024-01-10", "--date_tHOLD=2024-01-05",
            "--date_finish=2024-01-28", "--target_numbers=3,5", "--product_name=null",
            "--source_platform=adriver,dcm,ga,bq", "--achieve_mode=true", f"--flat_path={log}",
            f"--output_path={tmp_path / 'agg'}", f"--output_pathD={tmp_path / 'detail'}",
            "--single_file=true", "--heavy_share=500", "--heavy_rows=3", "--zone=Europe/Moscow"]
    assert cli.main(args) == 0
    detail = spark.read.option("header", "true").csv(str(tmp_path / "detail"))
    assert detail.count() == 216 and detail.select("ClientID").distinct().count() == 94
    agg = spark.read.option("header", "true").schema("user_path string, count bigint").csv(str(tmp_path / "agg"))
    assert agg.agg({"count": "sum"}).first()[0] == 216


def test_day_partition_pruning(spark, tmp_path):
    from pyspark.sql import functions as F

    import __spark_entry__ as E
    from pathfold.plans import reports
    from pathfold.sources import hits_from_events
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test data not present")
    log = str(tmp_path / "bydt")
    (hits_from_events(spark, sf).withColumn("dt", F.to_date(F.timestamp_millis("HitTimeStamp")))
     .write.partitionBy("dt").parquet(log))
    p = JobParams(**{**E.PARAMS.__dict__, "day_partition": "dt"})
    first, last = p.partition_days()
    assert (str(first), str(last)) == ("2024-01-03", "2024-01-28")
    pruned = read_hits(spark, log, day_column="dt", days=(first, last))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dt", plan), plan
    assert reports.detail_report(pruned, p).count() == 216
    assert reports.detail_report(read_hits(spark, log), p).count() == 216


def test_cli_pivot_and_top_end_to_end(spark, tmp_path, capsys):
    from pathfold import cli
    from pathfold.constants import CSV_HIT_COLUMNS
    from pathfold.sources import hits_from_events
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test data not present")
    hits = hits_from_events(spark, sf)
    log = str(tmp_path / "log")
    hits.write.parquet(log)
    args = ["pivot", "--projectID=3", "--date_start=2024-01-10", "--date_tHOLD=2024-01-10",
            "--date_finish=2024-01-28", "--target_numbers=[3,5]", "--product_name=null",
            "--source_platform=[adriver,dcm,ga,bq]", "--achieve_mode=true", f"--flat_path={log}",
            f"--output_path={tmp_path}/", "--output_pathD=unused", "--single_file=true"]
    assert cli.main(args) == 0
    out = glob.glob(str(tmp_path / "3_2024-01-10_2024-01-28_null_3;5" / "part-*.csv"))
    assert len(out) == 1
    pivot = spark.read.option("header", "true").schema(
        "paths string, true bigint, false bigint, share double").csv(out[0])
    total = pivot.agg({"true": "sum"}).first()[0]
    assert total > 0 and abs(pivot.agg({"share": "sum"}).first()[0] - 1.0) < 1e-9

    csv_log = str(tmp_path / "log.csv")
    hits.select(*CSV_HIT_COLUMNS).write.option("header", "true").option("sep", ";").csv(csv_log)
    config = str(tmp_path / "params.json")
    with open(config, "w") as f:
        json.dump({"projectID": 3, "date_start": "2024-01-10", "date_finish": "2024-01-28",
                   "target_numbers": [3, 5], "product_name": None,
                   "source_platform": ["adriver", "dcm", "ga", "bq"], "flat_path": csv_log,
                   "output_path": str(tmp_path)}, f)
    capsys.readouterr()
    assert cli.main(["top", config]) == 0
    shown = capsys.readouterr().out
    assert "paths" in shown and "count" in shown
