"""Whole jobs: parameters in, report files out."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import JobParams
from ..sinks import write_csv, write_window
from ..sources import read_csv_hits, read_hits
from . import reports
from .staging import Stages, job_key
from .variants import CANONICAL, CSV_ERA, NULL, V2, V3, Variant

PATH_VARIANTS = {"canonical": CANONICAL, "v3": V3, "null": NULL}


def _check_window(params: JobParams) -> None:
    if params.start_ms >= params.finish_ms:
        raise ValueError(f"the report window is empty: start {params.date_start!r}, finish {params.date_finish!r}")


def path_reports(spark: SparkSession, params: JobParams, variant: Variant = CANONICAL,
                 hits: DataFrame | None = None, merge_schema: bool = True,
                 single_file: bool = False, job: str | None = None, by_window: bool = False) -> dict[str, DataFrame]:
    """Detail report to ``output_path_detail`` and path counts (most frequent
    first) to ``output_path``.

    The detail is staged once as a Parquet table in the shared folder, and both
    reports read it.  The stages are kept until the job is done (see ``staging``):
    a rerun after a failure takes up the staged detail and does not write a
    finished report again.  It is the same job by its parameters and input files,
    or by the name ``job``.

    ``single_file`` writes each report as one file (one writer task per
    report); by default the writes stay parallel and the counts keep their
    order across part files.  ``by_window`` writes each report as the partition
    ``report_window=<start>_<finish>`` of its path and leaves other windows' files as
    they are.  Returns the job's diagnostics (hits per goal, hits
    per conversion mark): they come from the aggregate that the report needs
    anyway, so the log is read once for it and once for the report."""
    params.validate()
    if by_window and single_file:
        raise ValueError("single_file and by_window exclude each other")
    if hits is None:
        hits = read_hits(spark, params.flat_path, merge_schema=merge_schema,
                         day_column=params.day_partition, days=params.partition_days(),
                         day_format=params.day_format, needed=variant.needed(params))
    stages = Stages(spark, job or job_key(hits, params, variant, single_file, by_window))

    def make_detail() -> DataFrame:
        seen = reports.job_overview(hits, params, variant)
        told = [f(spark, seen).select(F.lit(name).alias("name"), F.col(key).cast("string").alias("key"), "count")
                for name, key, f in (("goals", "goal", reports.goal_counts_seen),
                                     ("conversions", "conversion", lambda s, x: reports.conversion_counts_seen(s, x, variant)))]
        told[0].union(told[1]).coalesce(1).write.mode("overwrite").parquet(os.path.join(stages.folder, "diagnostics"))
        return reports.detail_report(hits, params, variant, seen)

    detail = stages.table("detail", make_detail)  # and the diagnostics before it
    rows = spark.read.parquet(os.path.join(stages.folder, "diagnostics")).collect()  # a row per goal and mark
    counts = reports.aggregate_report(detail)
    if by_window:
        window = f"{params.date_start}_{params.date_finish}"
        stages.once("detail-report", lambda: write_window(detail, params.output_path_detail, window))
        stages.once("path-counts", lambda: write_window(counts, params.output_path, window, keep_order=True))
    else:
        stages.once("detail-report", lambda: write_csv(detail, params.output_path_detail, single_file=single_file))
        stages.once("path-counts", lambda: write_csv(counts, params.output_path, single_file=single_file,
                                                     sort_by=[F.desc("count"), F.asc("user_path")] if single_file else None))
    stages.done()
    told = {name: [(r.key, r["count"]) for r in rows if r["name"] == name] for name in ("goals", "conversions")}
    by_goal = (reports.goal_counts(hits, params, variant) if variant.goal_rule == "erase" else
               spark.createDataFrame([(int(k), n) for k, n in told["goals"]], "goal bigint, count bigint"))
    return {"goal_counts": by_goal, "conversion_counts": spark.createDataFrame(told["conversions"], "conversion string, count bigint")}


def pivot_report(spark: SparkSession, params: JobParams, hits: DataFrame | None = None,
                 single_file: bool = False) -> str:
    """Success / fail pivot with shares under output_path + report name."""
    _check_window(params)
    if hits is None:
        hits = read_hits(spark, params.flat_path, merge_schema=False,
                         day_column=params.day_partition, days=params.partition_days(),
                         day_format=params.day_format, needed=V2.needed(params))
    path = (params.output_path or "") + params.report_name()
    write_csv(reports.status_pivot(hits, params, V2), path, single_file=single_file,
              sort_by=[F.desc("true"), F.asc("paths")] if single_file else None)
    return path


def top_paths_report(spark: SparkSession, params: JobParams, k: int = 10,
                     hits: DataFrame | None = None) -> DataFrame:
    """The CSV-era job: top ``k`` success paths of utm-source channels."""
    _check_window(params)
    if hits is None:
        hits = read_csv_hits(spark, list(params.flat_path), needed=CSV_ERA.needed(params))
    return reports.top_paths(hits, params, k, CSV_ERA)
