"""

``entry(spark)`` runs the flagship query (path counts of converting clients)
on sf0.001; ``queries()`` maps every implemented operator / report to a
callable (spark, sf_dir) -> DataFrame over hits derived from the ``events``
table; ``oracle_sql()`` gives the same results as DuckDB SQL over the same
tables.  Path text and timelines are joined strings in both, so the two
engines hash alike.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# the package lives next to this file; make it importable from any working directory
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pathfold import JobParams, date_to_epoch_ms  # noqa: E402
from pathfold.functions import conversion_mark, local_midnight_ms, tagged_touch, touch_map  # noqa: E402
from pathfold.operators import clients as client_sets  # noqa: E402
from pathfold.operators import filters  # noqa: E402
from pathfold.plans import CANONICAL, CSV_ERA, NULL, V2, V3, jobs, reports  # noqa: E402
from pathfold.plans.variants import filtered_hits, scope  # noqa: E402
from pathfold.session import shared_dir  # noqa: E402
from pathfold.sinks import write_csv, write_window  # noqa: E402
from pathfold.sources import (events_to_hits, hits_from_events, read_bucketed_hits, read_config, read_csv_hits, read_hits,  # noqa: E402
                              write_bucketed_hits)
from pathfold.constants import CSV_HIT_COLUMNS  # noqa: E402

# Fixture parameters (FIXTURES.md section 3): project 3, goals 3 and 5, all
# four platforms, no product; Moscow midnight of the three days.
PARAMS = JobParams(project_id=3, date_start="2024-01-10", date_lookback="2024-01-05",
                   date_finish="2024-01-28", target_numbers=(3, 5),
                   source_platform=("adriver", "dcm", "ga", "bq"), achieve_mode="true")
FAIL_PARAMS = JobParams(**{**PARAMS.__dict__, "achieve_mode": "false"})
PRODUCT_PARAMS = JobParams(**{**PARAMS.__dict__, "product_name": "p1"})
# same report with every client of more than 1/2000 of the hits cut into chunks
# (the heavy-client path of the sequence scan)
SPLIT_PARAMS = JobParams(**{**PARAMS.__dict__, "heavy_share": 2000, "heavy_rows": 1})
# channels and paths as numbers in the shuffles
NUMBERED_PARAMS = JobParams(**{**PARAMS.__dict__, "channel_numbers": True})
# for the second mapping of events: the seizmik platform too
TIED_PARAMS = JobParams(**{**PARAMS.__dict__, "source_platform": ("adriver", "dcm", "seizmik", "ga", "bq")})
TIED_FAIL_PARAMS = JobParams(**{**TIED_PARAMS.__dict__, "achieve_mode": "false"})

HIT_COLS = ["ProjectID", "ClientID", "HitTimeStamp", "ga_sourcemedium", "utm_source", "utm_medium",
            "utm_campaign", "interaction_type", "dcm_placement_id", "profile", "ga_location", "goal",
            "src"]


def _all_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_from_events(spark, sf_dir)


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits in [look-back, finish), the widest range any report scope reads;
    the range also reaches the events scan as a filter on ``ts``."""
    return hits_from_events(spark, sf_dir, PARAMS.lookback_ms, PARAMS.finish_ms)


def _tied_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second mapping of events to hits, with what tells the variants apart:
    clients without id, clients without conversions, goals given as -1, the
    seizmik platform, and whole-hour timestamps, so that many hits of a client are
    at the same instant."""
    eid, buys = F.expr("event_id"), F.col("user_id") % 5 != 0
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    named = {"ClientID": F.when(eid % 23 == 0, None).otherwise(F.concat((F.col("user_id") % 400).cast("string"), F.lit("_"), (eid % 2).cast("string"))),
             "goal": F.when(buys & (F.col("event_type") == "signup"), 3).when(buys & (F.col("event_type") == "purchase"), 5)
             .when(F.col("event_type") == "error", 7).when((F.col("event_type") == "view") & (eid % 2 == 0), -1).cast("bigint"),
             "src": F.when(eid % 5 == 0, "adriver").when(eid % 5 == 1, "dcm").when(eid % 5 == 2, "ga").when(eid % 5 == 3, "bq").otherwise("seizmik")}
    base = events_to_hits(events, keep=("event_id", "user_id", "event_type"))
    ts = F.col("HitTimeStamp")
    return base.withColumns(named).withColumn("HitTimeStamp", ts - ts % 3_600_000).select(*HIT_COLS)


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def q_paths_success_agg(spark, sf_dir):
    return reports.path_counts(_hits(spark, sf_dir), PARAMS)


def q_paths_success_agg_hot_split(spark, sf_dir):
    return reports.path_counts(_hits(spark, sf_dir), SPLIT_PARAMS)


def q_paths_status_pivot_hot_split(spark, sf_dir):
    return reports.status_pivot(_hits(spark, sf_dir), SPLIT_PARAMS, V2)


def q_paths_fail_agg(spark, sf_dir):
    return reports.path_counts(_hits(spark, sf_dir), FAIL_PARAMS)


def q_paths_success_detail(spark, sf_dir):
    return reports.detail_report(_hits(spark, sf_dir), PARAMS)


def q_paths_fail_detail(spark, sf_dir):
    return reports.detail_report(_hits(spark, sf_dir), FAIL_PARAMS)


def q_paths_v3_detail(spark, sf_dir):
    return reports.detail_report(_hits(spark, sf_dir), PARAMS, V3)


def q_paths_v3_agg(spark, sf_dir):
    return reports.path_counts(_hits(spark, sf_dir), PARAMS, V3)


def q_paths_null_detail(spark, sf_dir):
    return reports.detail_report(_hits(spark, sf_dir), PARAMS, NULL)


def q_paths_null_agg(spark, sf_dir):
    return reports.path_counts(_hits(spark, sf_dir), PARAMS, NULL)


def q_paths_status_pivot(spark, sf_dir):
    return reports.status_pivot(_hits(spark, sf_dir), PARAMS, V2)


def q_utm_source_paths_top10(spark, sf_dir):
    return reports.top_paths(_hits(spark, sf_dir), PARAMS, 10, CSV_ERA)


def q_hits_scan(spark, sf_dir):
    return _all_hits(spark, sf_dir)


def q_hits_in_scope(spark, sf_dir):
    return filtered_hits(_hits(spark, sf_dir), PARAMS, CANONICAL)


def q_hits_in_window(spark, sf_dir):
    p = PARAMS
    return filters.apply(_hits(spark, sf_dir), filters.time_range(p.start_ms, p.finish_ms),
                         filters.project_is(p.project_id), filters.platform_in(p.source_platform))


def q_hits_product_filter(spark, sf_dir):
    return filtered_hits(_hits(spark, sf_dir), PRODUCT_PARAMS, CANONICAL)


def q_channel_label(spark, sf_dir):
    from pathfold.functions import channel_label
    return filtered_hits(_hits(spark, sf_dir), PARAMS, CANONICAL).select(
        "ClientID", "HitTimeStamp", "src", "interaction_type", channel_label().alias("channel"))


def q_goal_normalised(spark, sf_dir):
    return scope(_hits(spark, sf_dir), PARAMS, CANONICAL).select("ClientID", "HitTimeStamp", "goal")


def q_goal_null_to_transit(spark, sf_dir):
    return scope(_hits(spark, sf_dir), PARAMS, V3).select("ClientID", "HitTimeStamp", "goal")


def q_conversion_flag(spark, sf_dir):
    return scope(_hits(spark, sf_dir), PARAMS, CANONICAL).select(
        "ClientID", "HitTimeStamp", "channel", conversion_mark(F.col("conv")).alias("conversion"))


def q_tagged_touch(spark, sf_dir):
    return scope(_hits(spark, sf_dir), PARAMS, CANONICAL).select(
        "ClientID", "HitTimeStamp", tagged_touch(F.col("channel"), F.col("conv")).alias("channel_conv"))


def q_date_bounds(spark, sf_dir):
    """Local midnights of the days in ``events``: as a column expression, and as
    the jobs have them from their parameters."""
    days = (spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
            .select(F.to_date("ts").cast("string").alias("day")).distinct())
    known = [(r.day, date_to_epoch_ms(r.day, PARAMS.zone)) for r in days.where("day is not null").collect()]  # one row a day
    return (days.join(spark.createDataFrame(known, "day string, job_midnight_ms bigint"), "day")
            .select("day", local_midnight_ms(F.col("day"), PARAMS.zone).alias("midnight_ms"), "job_midnight_ms"))


def q_converters(spark, sf_dir):
    return client_sets.converters(scope(_hits(spark, sf_dir), PARAMS, CANONICAL))


def q_nonconverters(spark, sf_dir):
    return client_sets.nonconverters(scope(_hits(spark, sf_dir), PARAMS, CANONICAL))


def q_converter_hits(spark, sf_dir):
    return client_sets.converter_hits(scope(_hits(spark, sf_dir), PARAMS, CANONICAL)).select(
        "ClientID", "HitTimeStamp", "channel", "goal")


def q_nonconverter_hits(spark, sf_dir):
    return client_sets.nonconverter_hits(scope(_hits(spark, sf_dir), PARAMS, CANONICAL)).select(
        "ClientID", "HitTimeStamp", "channel", "goal")


def q_client_sequences(spark, sf_dir):
    return reports.client_sequences(_hits(spark, sf_dir), PARAMS, CANONICAL)


def q_lookback_trim(spark, sf_dir):
    return reports.lookback_trim(_hits(spark, sf_dir), PARAMS, CANONICAL)


def q_segments(spark, sf_dir):
    return reports.path_segments(_hits(spark, sf_dir), PARAMS, CANONICAL, mode="both", clients="all")


def q_goal_counts(spark, sf_dir):
    return reports.goal_counts(_hits(spark, sf_dir), PARAMS, CANONICAL)


def q_conversion_counts(spark, sf_dir):
    return reports.conversion_counts(_hits(spark, sf_dir), PARAMS, CANONICAL)


def q_csv_scan(spark, sf_dir):
    """Write the CSV-era log (8 columns, ';', header) to the shared folder and
    read it back through the CSV source."""
    path = _scratch(spark, "csv-hits")
    _all_hits(spark, sf_dir).select(*CSV_HIT_COLUMNS).write.option("header", "true") \
        .option("sep", ";").csv(path)
    return read_csv_hits(spark, path)


def q_report_csv_roundtrip(spark, sf_dir):
    """Write the detail report as CSV and read it back."""
    path = _scratch(spark, "detail-report")
    write_csv(reports.detail_report(_hits(spark, sf_dir), PARAMS), path)
    schema = "ClientID string, user_path string, timeline string, target_numbers string"
    return spark.read.option("header", "true").schema(schema).csv(path)


def q_report_agg_csv_roundtrip(spark, sf_dir):
    """Write the path counts as CSV, in parallel, and read them back."""
    path = _scratch(spark, "agg-report")
    write_csv(reports.path_counts(_hits(spark, sf_dir), PARAMS), path)
    return spark.read.option("header", "true").schema("user_path string, count bigint").csv(path)


def q_report_pivot_csv_roundtrip(spark, sf_dir):
    """Write the success / fail pivot as CSV and read it back."""
    path = _scratch(spark, "pivot-report")
    write_csv(reports.status_pivot(_hits(spark, sf_dir), PARAMS, V2), path)
    schema = "paths string, true bigint, false bigint, share double"
    return spark.read.option("header", "true").schema(schema).csv(path)


def q_read_merged_logs(spark, sf_dir):
    """Two parquet logs read as one with merged schemas: hits at even milliseconds
    under today's column names, the others under the older ones and without placement."""
    new, old = _scratch(spark, "log-new"), _scratch(spark, "log-old")
    hits, even = _all_hits(spark, sf_dir), F.col("HitTimeStamp") % 2 == 0
    hits.where(even).write.parquet(new)
    (hits.where(~even).withColumnRenamed("interaction_type", "adr_typenum").withColumnRenamed("profile", "adr_profile")
     .drop("dcm_placement_id").write.parquet(old))
    return read_hits(spark, [new, old])


def q_read_unmerged_log(spark, sf_dir):
    """A parquet log read without merging schemas."""
    path = _scratch(spark, "log")
    _all_hits(spark, sf_dir).write.parquet(path)
    return read_hits(spark, path, merge_schema=False)


def q_read_csv_orders(spark, sf_dir):
    """Two CSV logs whose columns stand in different order."""
    one, two = _scratch(spark, "csv-one"), _scratch(spark, "csv-two")
    hits, even = _all_hits(spark, sf_dir), F.col("HitTimeStamp") % 2 == 0
    for part, columns, path in ((even, CSV_HIT_COLUMNS, one), (~even, CSV_HIT_COLUMNS[::-1], two)):
        hits.where(part).select(*columns).write.option("header", "true").option("sep", ";").csv(path)
    return read_csv_hits(spark, [one, two])


def q_conversion_flag_old(spark, sf_dir):
    return scope(_hits(spark, sf_dir), PARAMS, CSV_ERA).select(
        "ClientID", "HitTimeStamp", "channel", conversion_mark(F.col("conv"), old_style=True).alias("conversion"))


def q_tagged_touch_old(spark, sf_dir):
    return scope(_hits(spark, sf_dir), PARAMS, CSV_ERA).select(
        "ClientID", "HitTimeStamp", tagged_touch(F.col("channel"), F.col("conv"), old_style=True).alias("channel_conv"))


def q_touch_map(spark, sf_dir):
    """The touch records, each map's entry as key and value."""
    return scope(_hits(spark, sf_dir), PARAMS, CANONICAL).select(
        "ClientID", F.explode(touch_map(tagged_touch(F.col("channel"), F.col("conv")))).alias("touch", "ts"))


def q_pivot_job(spark, sf_dir):
    """The pivot job's report under the name that the job gives it."""
    params = JobParams(**{**PARAMS.__dict__, "output_path": _scratch(spark, "pivot-job")})
    path = jobs.pivot_report(spark, params, hits=_hits(spark, sf_dir))
    if not path.endswith("3_2024-01-10_2024-01-28_None_3;5"):
        raise ValueError(f"unexpected report name {path}")
    schema = "paths string, true bigint, false bigint, share double"
    return spark.read.option("header", "true").schema(schema).csv(path)


def q_read_schema_groups(spark, sf_dir):
    """A log by day whose files do not merge: goals are longs, ints under names in
    another case, or texts."""
    log, hits, day = _scratch(spark, "log-kinds"), _all_hits(spark, sf_dir), F.col("HitTimeStamp") % 3
    kinds = [hits, hits.withColumn("goal", F.col("goal").cast("int")).withColumnsRenamed({"ClientID": "CLIENTID", "utm_source": "UTM_Source"}),
             hits.withColumn("goal", F.col("goal").cast("string"))]
    for i, kind in enumerate(kinds):
        kind.where(day == i).write.parquet(f"{log}/part={i}")
    return read_hits(spark, log)


def _bucketed(spark, sf_dir):
    """The hits as a log bucketed by client, written and read again."""
    path = _scratch(spark, "log-by-client")
    table = "hits_" + uuid.uuid4().hex
    write_bucketed_hits(_hits(spark, sf_dir), table, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_bucketed_hits(spark, table)


def q_paths_bucketed_agg(spark, sf_dir):
    return reports.path_counts(_bucketed(spark, sf_dir), PARAMS)


def q_paths_bucketed_pivot(spark, sf_dir):
    return reports.status_pivot(_bucketed(spark, sf_dir), PARAMS, V2)


def q_paths_numbered_agg(spark, sf_dir):
    return reports.path_counts(_hits(spark, sf_dir), NUMBERED_PARAMS)


def q_paths_numbered_detail(spark, sf_dir):
    return reports.detail_report(_hits(spark, sf_dir), NUMBERED_PARAMS)


def q_paths_numbered_pivot(spark, sf_dir):
    return reports.status_pivot(_hits(spark, sf_dir), NUMBERED_PARAMS, V2)


def q_paths_job(spark, sf_dir):
    """The whole path job over a Parquet log: both reports read back from their
    CSV files, and the diagnostics."""
    log, out = _scratch(spark, "job-log"), _scratch(spark, "path-job")
    _hits(spark, sf_dir).write.parquet(log)
    params = JobParams(**{**PARAMS.__dict__, "flat_path": (log,), "output_path": f"{out}-agg", "output_path_detail": f"{out}-detail"})
    told = jobs.path_reports(spark, params)
    csv = spark.read.option("header", "true")
    detail = csv.schema("ClientID string, user_path string, timeline string, target_numbers string").csv(params.output_path_detail)
    agg = csv.schema("user_path string, count bigint").csv(params.output_path)
    none = F.lit(None).cast("string")
    row = lambda report, item, count, client=none, timeline=none: (
        F.lit(report).alias("report"), client.alias("ClientID"), item.alias("item"), timeline.alias("timeline"), count.alias("count"))
    return (detail.select(*row("detail", F.col("user_path"), F.lit(None).cast("bigint"), F.col("ClientID"), F.col("timeline")))
            .union(agg.select(*row("paths", F.col("user_path"), F.col("count"))))
            .union(told["goal_counts"].select(*row("goals", F.col("goal").cast("string"), F.col("count"))))
            .union(told["conversion_counts"].select(*row("conversions", F.col("conversion"), F.col("count")))))


def q_report_by_window(spark, sf_dir):
    """Two reports as partitions of one path; the first is written once more after the second."""
    path, hits = _scratch(spark, "by-window"), _hits(spark, sf_dir)
    for params, window in ((PARAMS, "success"), (FAIL_PARAMS, "fail"), (PARAMS, "success")):
        write_window(reports.path_counts(hits, params), path, window, keep_order=True)
    return spark.read.option("header", "true").schema("user_path string, count bigint, report_window string").csv(path)


def q_top_paths_from_config(spark, sf_dir):
    """The CSV-era job from its JSON config: config and log are written, the job
    reads the config and the log that it names."""
    log, config = _scratch(spark, "csv-log"), _scratch(spark, "config")
    _all_hits(spark, sf_dir).select(*CSV_HIT_COLUMNS).write.option("header", "true").option("sep", ";").csv(log)
    record = {"projectID": PARAMS.project_id, "date_start": PARAMS.date_start, "date_finish": PARAMS.date_finish,
              "target_numbers": list(PARAMS.target_numbers), "product_name": None, "source_platform": list(PARAMS.source_platform),
              "flat_path": log, "output_path": ""}
    spark.createDataFrame([(json.dumps(record),)], "value string").write.text(config)
    return jobs.top_paths_report(spark, read_config(spark, config))


def _tied(report, params, variant):
    return lambda spark, sf_dir: report(_tied_hits(spark, sf_dir), params, variant)


#: (variant, parameters) of the reports over the second mapping
_TIED = {"canonical": (CANONICAL, TIED_PARAMS), "canonical_fail": (CANONICAL, TIED_FAIL_PARAMS), "v3": (V3, TIED_PARAMS),
         "null": (NULL, TIED_PARAMS), "v2": (V2, TIED_PARAMS), "csv": (CSV_ERA, TIED_PARAMS)}

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "paths_success_agg": q_paths_success_agg,
    "paths_success_agg_hot_split": q_paths_success_agg_hot_split,
    "hits_scan": q_hits_scan,
    "hits_in_scope": q_hits_in_scope,
    "hits_in_window": q_hits_in_window,
    "hits_product_filter": q_hits_product_filter,
    "channel_label": q_channel_label,
    "goal_normalised": q_goal_normalised,
    "goal_null_to_transit": q_goal_null_to_transit,
    "conversion_flag": q_conversion_flag,
    "tagged_touch": q_tagged_touch,
    "date_bounds": q_date_bounds,
    "converters": q_converters,
    "nonconverters": q_nonconverters,
    "converter_hits": q_converter_hits,
    "nonconverter_hits": q_nonconverter_hits,
    "client_sequences": q_client_sequences,
    "lookback_trim": q_lookback_trim,
    "segments": q_segments,
    "paths_success_detail": q_paths_success_detail,
    "paths_fail_detail": q_paths_fail_detail,
    "paths_fail_agg": q_paths_fail_agg,
    "paths_v3_detail": q_paths_v3_detail,
    "paths_v3_agg": q_paths_v3_agg,
    "paths_null_detail": q_paths_null_detail,
    "paths_null_agg": q_paths_null_agg,
    "paths_status_pivot": q_paths_status_pivot,
    "paths_status_pivot_hot_split": q_paths_status_pivot_hot_split,
    "utm_source_paths_top10": q_utm_source_paths_top10,
    "goal_counts": q_goal_counts,
    "conversion_counts": q_conversion_counts,
    "csv_scan": q_csv_scan,
    "report_csv_roundtrip": q_report_csv_roundtrip,
    "report_agg_csv_roundtrip": q_report_agg_csv_roundtrip,
    "report_pivot_csv_roundtrip": q_report_pivot_csv_roundtrip,
    "read_merged_logs": q_read_merged_logs,
    "read_unmerged_log": q_read_unmerged_log,
    "read_csv_orders": q_read_csv_orders,
    "conversion_flag_old": q_conversion_flag_old,
    "tagged_touch_old": q_tagged_touch_old,
    "touch_map": q_touch_map,
    "pivot_job": q_pivot_job,
    "read_schema_groups": q_read_schema_groups,
    "paths_bucketed_agg": q_paths_bucketed_agg,
    "paths_bucketed_pivot": q_paths_bucketed_pivot,
    "paths_numbered_agg": q_paths_numbered_agg,
    "paths_numbered_detail": q_paths_numbered_detail,
    "paths_numbered_pivot": q_paths_numbered_pivot,
    "paths_job": q_paths_job,
    "report_by_window": q_report_by_window,
    "top_paths_from_config": q_top_paths_from_config,
    **{f"tied_{name}_detail": _tied(reports.detail_report, p, v) for name, (v, p) in _TIED.items()},
    **{f"tied_{name}_agg": _tied(reports.path_counts, p, v) for name, (v, p) in _TIED.items()},
    **{f"tied_{name}_pivot": _tied(reports.status_pivot, p, v) for name, (v, p) in _TIED.items() if name != "canonical_fail"},
}


# The training-data operators are a separate subpackage with their own queries
# and SQL; everything else works without it.
_LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_ORACLE: dict[str, str] = {}
try:
    from pathfold.llm import queries as _llm  # noqa: E402
    import corpus_pipeline as _corpus_pipeline  # noqa: E402
except ModuleNotFoundError as e:
    if not (e.name or "").startswith(("pathfold.llm", "corpus_pipeline")):
        raise
else:
    _LLM_QUERIES.update(_llm.QUERIES, pipeline=_corpus_pipeline.run)
    _LLM_ORACLE.update(_llm.ORACLE)
    if _corpus_pipeline.ORACLE_SQL is not None:
        _LLM_ORACLE["pipeline"] = _corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: clients per converting path on sf0.001."""
    return q_paths_success_agg(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _LLM_QUERIES


# ---------------------------------------------------------------------------
# DuckDB oracle: the textbook single-window formulation over the same hits
# ---------------------------------------------------------------------------

_HITS_CTE = """hits AS (
  SELECT
    CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 3 END AS BIGINT) AS ProjectID,
    CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 7 AS VARCHAR) AS ClientID,
    CAST(epoch_us(ts) // 1000 AS BIGINT) AS HitTimeStamp,
    CASE WHEN event_id % 4 IN (2, 3) THEN 'site' || CAST(user_id % 3 AS VARCHAR) || ' / cpc' END
      AS ga_sourcemedium,
    'u' || CAST(event_id % 3 AS VARCHAR) AS utm_source,
    'cpm' AS utm_medium,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'c' || CAST(event_id % 2 AS VARCHAR) END AS utm_campaign,
    CASE WHEN event_type = 'view' THEN 'view' ELSE 'click' END AS interaction_type,
    'pl' || CAST(event_id % 2 AS VARCHAR) AS dcm_placement_id,
    'pr' || CAST(event_id % 2 AS VARCHAR) AS profile,
    'p' || CAST(event_id % 2 AS VARCHAR) AS ga_location,
    CAST(CASE event_type WHEN 'signup' THEN 3 WHEN 'purchase' THEN 5 WHEN 'error' THEN 7 END AS BIGINT)
      AS goal,
    CASE event_id % 4 WHEN 0 THEN 'adriver' WHEN 1 THEN 'dcm' WHEN 2 THEN 'ga' ELSE 'bq' END AS src
  FROM events)"""

# the second mapping, see _tied_hits
_TIED_CTE = """hits AS (
  SELECT
    CAST(CASE WHEN event_id % 10 = 0 THEN 1 ELSE 3 END AS BIGINT) AS ProjectID,
    CASE WHEN event_id % 23 <> 0 THEN CAST(user_id % 400 AS VARCHAR) || '_' || CAST(event_id % 2 AS VARCHAR) END AS ClientID,
    CAST(epoch_us(ts) // 1000 - epoch_us(ts) // 1000 % 3600000 AS BIGINT) AS HitTimeStamp,
    CASE WHEN event_id % 4 IN (2, 3) THEN 'site' || CAST(user_id % 3 AS VARCHAR) || ' / cpc' END AS ga_sourcemedium,
    'u' || CAST(event_id % 3 AS VARCHAR) AS utm_source,
    'cpm' AS utm_medium,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'c' || CAST(event_id % 2 AS VARCHAR) END AS utm_campaign,
    CASE WHEN event_type = 'view' THEN 'view' ELSE 'click' END AS interaction_type,
    'pl' || CAST(event_id % 2 AS VARCHAR) AS dcm_placement_id,
    'pr' || CAST(event_id % 2 AS VARCHAR) AS profile,
    CAST(CASE WHEN user_id % 5 <> 0 AND event_type = 'signup' THEN 3 WHEN user_id % 5 <> 0 AND event_type = 'purchase' THEN 5
      WHEN event_type = 'error' THEN 7
      WHEN event_type = 'view' AND event_id % 2 = 0 THEN -1 END AS BIGINT) AS goal,
    CASE event_id % 5 WHEN 0 THEN 'adriver' WHEN 1 THEN 'dcm' WHEN 2 THEN 'ga' WHEN 3 THEN 'bq' ELSE 'seizmik' END AS src
  FROM events)"""
_TIED_SOURCES = "'adriver', 'dcm', 'ga', 'bq', 'seizmik'"

_CHANNEL = """CASE
    WHEN src = 'adriver' AND interaction_type IN ('view', 'click') THEN interaction_type || ':'
      || coalesce(utm_source, 'null') || ' / ' || coalesce(utm_medium, 'null') || ' / '
      || coalesce(utm_campaign, 'null') || ':' || coalesce(profile, 'null')
    WHEN src = 'dcm' AND interaction_type IN ('view', 'click') THEN interaction_type || ':'
      || coalesce(utm_source, 'null') || ' / ' || coalesce(utm_medium, 'null') || ' / '
      || coalesce(utm_campaign, 'null') || ':' || coalesce(dcm_placement_id, 'null')
    WHEN src = 'seizmik' THEN 'seizmik_channel'
    WHEN src IN ('ga', 'bq') THEN coalesce(ga_sourcemedium, 'null') || ' / ' || coalesce(utm_campaign, 'null')
    ELSE error('Unknown data source')
  END"""

_P = PARAMS
_TARGETS = ", ".join(str(t) for t in _P.target_numbers)
_SOURCES = ", ".join(f"'{s}'" for s in _P.source_platform)



_WINDOW = f"HitTimeStamp >= {_P.start_ms} AND HitTimeStamp < {_P.finish_ms} AND ProjectID = 3"
_LOOKBACK = f"HitTimeStamp >= {_P.lookback_ms} AND HitTimeStamp < {_P.finish_ms} AND ProjectID = 3"
_AFTER, _BEFORE = f"HitTimeStamp >= {_P.start_ms}", f"HitTimeStamp < {_P.start_ms}"

# What each report reads and how it sees a hit, written out by itself: where, channel, goal,
# conv (ends a path), qual (makes its client a converter), pre (before the start: cut away up to it),
# trim, mode, clients.
_RULES = {
    "canonical": dict(where=f"{_LOOKBACK} AND ClientID IS NOT NULL AND (goal IS NULL OR goal IN (3, 5))", channel=_CHANNEL,
                      goal="CASE WHEN goal IN (3, 5) THEN goal ELSE -1 END", conv="goal IN (3, 5)", qual=f"goal IN (3, 5) AND {_AFTER}",
                      pre=f"goal IN (3, 5) AND {_BEFORE}", trim=True, mode="success", clients="converters"),
    "v3": dict(where=f"{_LOOKBACK} AND ClientID IS NOT NULL AND coalesce(goal, -1) IN (3, 5, -1)", channel=_CHANNEL,
               goal="coalesce(goal, -1)", conv="goal <> -1", qual=f"goal <> -1 AND {_AFTER}", pre=f"goal <> -1 AND {_BEFORE}",
               trim=True, mode="success", clients="converters"),
    "null": dict(where=f"{_WINDOW} AND ClientID IS NOT NULL", channel=_CHANNEL, goal="coalesce(goal, -1)", conv="false",
                 qual="goal IN (3, 5)", pre="false", trim=False, mode="fail", clients="nonconverters"),
    "v2": dict(where=f"{_WINDOW} AND coalesce(goal, -1) IN (3, 5, -1)", channel=_CHANNEL, goal="coalesce(goal, -1)",
               conv="goal <> -1", qual=f"goal <> -1 AND {_AFTER}", pre="false", trim=False, mode="both", clients="all"),
    "csv": dict(where=f"{_WINDOW} AND coalesce(goal, -1) IN (3, 5, -1)", channel="coalesce(utm_source, 'null')",
                goal="coalesce(goal, -1)", conv="goal <> -1", qual=f"goal <> -1 AND {_AFTER}", pre="false", trim=False,
                mode="success", clients="all"),
}
_RULES["canonical_fail"] = _RULES["canonical"] | dict(mode="fail", clients="nonconverters")


def _where(rule: str, sources: str = _SOURCES) -> str:
    return f"{_RULES[rule]['where']} AND src IN ({sources})"


def _flags_cte(rule: str, sources: str = _SOURCES) -> str:
    """hits -> flags(ClientID, HitTimeStamp, channel, goal, conv, qual, pre)."""
    r = _RULES[rule]
    return f"""scoped AS (
  SELECT ClientID, HitTimeStamp, {r['channel']} AS channel, CAST({r['goal']} AS BIGINT) AS goal
  FROM hits WHERE {_where(rule, sources)}),
flags AS (
  SELECT ClientID, HitTimeStamp, channel, goal, {r['conv']} AS conv, {r['qual']} AS qual, {r['pre']} AS pre
  FROM scoped)"""


_SEQ_CTE = """seq AS (
  SELECT *,
    CAST(row_number() OVER w AS BIGINT) AS rn,
    CAST(coalesce(sum(CAST(conv AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS BIGINT) AS seg,
    sum(CAST(conv AS BIGINT)) OVER (PARTITION BY ClientID) AS client_conv,
    sum(CAST(pre AS BIGINT)) OVER (PARTITION BY ClientID) AS client_pre,
    sum(CAST(qual AS BIGINT)) OVER (PARTITION BY ClientID) AS client_qual
  FROM flags
  WINDOW w AS (PARTITION BY ClientID ORDER BY HitTimeStamp, conv, channel))"""


def _keep(mode: str, clients: str, trim: bool) -> str:
    conds = ["true"]
    if trim:
        conds.append("seg >= client_pre")
    if mode == "success":
        conds.append("seg < client_conv")
    elif mode == "fail":
        conds.append("seg = client_conv")
    if clients == "converters":
        conds.append("client_qual > 0")
    elif clients == "nonconverters":
        conds.append("client_qual = 0")
    return " AND ".join(conds)


def _segs_cte(mode: str, clients: str, trim: bool) -> str:
    return f"""segs AS (
  SELECT ClientID, seg,
    string_agg(channel, '=>' ORDER BY rn) AS user_path,
    string_agg(CAST(HitTimeStamp AS VARCHAR), '=>' ORDER BY rn) AS timeline,
    bool_or(conv) AS status,
    CAST(count(*) AS BIGINT) AS n_touches
  FROM seq WHERE {_keep(mode, clients, trim)}
  GROUP BY ClientID, seg)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _paths_sql(rule, final: str, mode=None, clients=None, hits: str | None = None, sources: str = _SOURCES) -> str:
    r = _RULES[rule]
    return _with(hits or _HITS_CTE, _flags_cte(rule, sources), _SEQ_CTE,
                 _segs_cte(mode or r["mode"], clients or r["clients"], r["trim"])) + final


_DETAIL = f"SELECT ClientID, user_path, timeline, '{_P.targets_csv}' AS target_numbers FROM segs"
_AGG = 'SELECT user_path, CAST(count(ClientID) AS BIGINT) AS "count" FROM segs GROUP BY user_path'
_ALL_HIT_COLS = ", ".join(HIT_COLS)
_PIVOT = ('SELECT user_path AS paths, '
          'CAST(sum(CASE WHEN status THEN 1 END) AS BIGINT) AS "true", '
          'CAST(sum(CASE WHEN NOT status THEN 1 END) AS BIGINT) AS "false", '
          'CAST(sum(CASE WHEN status THEN 1 END) AS DOUBLE) '
          '/ nullif((SELECT count(*) FROM segs WHERE status), 0) AS share '
          'FROM segs GROUP BY user_path')


def oracle_sql() -> dict[str, str]:
    canon = _with(_HITS_CTE, _flags_cte("canonical"))
    top10 = ('SELECT user_path AS paths, CAST(count(*) AS BIGINT) AS "count" FROM segs '
             'GROUP BY user_path ORDER BY "count" DESC, paths ASC LIMIT 10')
    v3 = _with(_HITS_CTE, _flags_cte("v3"))
    seq = _with(_HITS_CTE, _flags_cte("canonical"), _SEQ_CTE)
    csv_cols = set(CSV_HIT_COLUMNS)
    csv_select = ", ".join(c if c in csv_cols else f"CAST(NULL AS VARCHAR) AS {c}" for c in HIT_COLS)
    return _LLM_ORACLE | {
        "paths_success_agg": _paths_sql("canonical", _AGG),
        "paths_success_agg_hot_split": _paths_sql("canonical", _AGG),
        "hits_scan": _with(_HITS_CTE) + f"SELECT {_ALL_HIT_COLS} FROM hits",
        "hits_in_scope": _with(_HITS_CTE) + f"SELECT {_ALL_HIT_COLS} FROM hits WHERE {_where("canonical")}",
        "hits_in_window": _with(_HITS_CTE) + (
            f"SELECT {_ALL_HIT_COLS} FROM hits WHERE HitTimeStamp >= {_P.start_ms} "
            f"AND HitTimeStamp < {_P.finish_ms} AND ProjectID = {_P.project_id} AND src IN ({_SOURCES})"),
        "hits_product_filter": _with(_HITS_CTE) + (
            f"SELECT {_ALL_HIT_COLS} FROM hits WHERE {_where("canonical")} AND ga_location = 'p1'"),
        "channel_label": _with(_HITS_CTE) + (
            f"SELECT ClientID, HitTimeStamp, src, interaction_type, {_CHANNEL} AS channel "
            f"FROM hits WHERE {_where("canonical")}"),
        "goal_normalised": canon + "SELECT ClientID, HitTimeStamp, goal FROM flags",
        "goal_null_to_transit": v3 + "SELECT ClientID, HitTimeStamp, goal FROM flags",
        "conversion_flag": canon + (
            "SELECT ClientID, HitTimeStamp, channel, "
            "CASE WHEN conv THEN 'get@conv' ELSE 'get@no_conv' END AS conversion FROM flags"),
        "tagged_touch": canon + (
            "SELECT ClientID, HitTimeStamp, "
            "channel || '::_' || CASE WHEN conv THEN 'get@conv' ELSE 'get@no_conv' END AS channel_conv "
            "FROM flags"),
        "date_bounds": (
            "SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, "
            f"epoch_ms(timezone('{_P.zone}', CAST(CAST(ts AS DATE) AS TIMESTAMP))) AS midnight_ms, "
            f"epoch_ms(timezone('{_P.zone}', CAST(CAST(ts AS DATE) AS TIMESTAMP))) AS job_midnight_ms "
            "FROM events"),
        "converters": canon + "SELECT DISTINCT ClientID FROM flags WHERE qual",
        "nonconverters": canon + (
            "SELECT ClientID FROM flags EXCEPT SELECT ClientID FROM flags WHERE qual"),
        "converter_hits": canon + (
            "SELECT ClientID, HitTimeStamp, channel, goal FROM flags "
            "WHERE ClientID IN (SELECT ClientID FROM flags WHERE qual)"),
        "nonconverter_hits": canon + (
            "SELECT ClientID, HitTimeStamp, channel, goal FROM flags f WHERE ClientID IS NOT NULL "
            "AND NOT EXISTS (SELECT 1 FROM flags c WHERE c.qual AND c.ClientID = f.ClientID)"),
        "client_sequences": seq + (
            "SELECT ClientID, HitTimeStamp, channel, conv, rn, seg, "
            "channel || '::_' || CASE WHEN conv THEN 'get@conv' ELSE 'get@no_conv' END AS channel_conv "
            "FROM seq"),
        "lookback_trim": seq + (
            "SELECT ClientID, HitTimeStamp, channel, conv, rn FROM seq "
            "WHERE seg >= client_pre AND client_qual > 0"),
        "segments": _paths_sql("canonical", "SELECT * FROM segs", "both", "all"),
        "paths_success_detail": _paths_sql("canonical", _DETAIL),
        "paths_fail_detail": _paths_sql("canonical_fail", _DETAIL),
        "paths_fail_agg": _paths_sql("canonical_fail", _AGG),
        "paths_v3_detail": _paths_sql("v3", _DETAIL),
        "paths_v3_agg": _paths_sql("v3", _AGG),
        "paths_null_detail": _paths_sql("null", _DETAIL),
        "paths_null_agg": _paths_sql("null", _AGG),
        "paths_status_pivot": _paths_sql("v2", _PIVOT),
        "paths_status_pivot_hot_split": _paths_sql("v2", _PIVOT),
        "utm_source_paths_top10": _paths_sql("csv", top10),
        "goal_counts": canon + 'SELECT goal, CAST(count(ClientID) AS BIGINT) AS "count" FROM flags GROUP BY goal',
        "conversion_counts": canon + (
            "SELECT CASE WHEN conv THEN 'get@conv' ELSE 'get@no_conv' END AS conversion, "
            'CAST(count(ClientID) AS BIGINT) AS "count" FROM flags '
            "WHERE ClientID IN (SELECT ClientID FROM flags WHERE qual) GROUP BY 1"),
        "csv_scan": _with(_HITS_CTE) + f"SELECT {csv_select} FROM hits",
        "report_csv_roundtrip": _paths_sql("canonical", _DETAIL),
        "report_agg_csv_roundtrip": _paths_sql("canonical", _AGG),
        "report_pivot_csv_roundtrip": _paths_sql("v2", _PIVOT),
        "read_merged_logs": _with(_HITS_CTE) + "SELECT " + _ALL_HIT_COLS.replace(
            "dcm_placement_id", "CASE WHEN HitTimeStamp % 2 = 0 THEN dcm_placement_id END AS dcm_placement_id") + " FROM hits",
        "read_unmerged_log": _with(_HITS_CTE) + f"SELECT {_ALL_HIT_COLS} FROM hits",
        "read_csv_orders": _with(_HITS_CTE) + f"SELECT {csv_select} FROM hits",
        "conversion_flag_old": _with(_HITS_CTE, _flags_cte("csv")) + (
            "SELECT ClientID, HitTimeStamp, channel, CASE WHEN conv THEN '1' ELSE '0' END AS conversion FROM flags"),
        "tagged_touch_old": _with(_HITS_CTE, _flags_cte("csv")) + (
            "SELECT ClientID, HitTimeStamp, channel || '_' || CASE WHEN conv THEN '1' ELSE '0' END AS channel_conv FROM flags"),
        "touch_map": canon + (
            "SELECT ClientID, channel || '::_' || CASE WHEN conv THEN 'get@conv' ELSE 'get@no_conv' END AS touch, "
            "HitTimeStamp AS ts FROM flags"),
        "pivot_job": _paths_sql("v2", _PIVOT),
        "read_schema_groups": _with(_HITS_CTE) + f"SELECT {_ALL_HIT_COLS} FROM hits",
        "paths_bucketed_agg": _paths_sql("canonical", _AGG),
        "paths_bucketed_pivot": _paths_sql("v2", _PIVOT),
        "paths_numbered_agg": _paths_sql("canonical", _AGG),
        "paths_numbered_detail": _paths_sql("canonical", _DETAIL),
        "paths_numbered_pivot": _paths_sql("v2", _PIVOT),
        "paths_job": _paths_sql("canonical", (
            "SELECT 'detail' AS report, ClientID, user_path AS item, timeline, CAST(NULL AS BIGINT) AS \"count\" FROM segs "
            "UNION ALL SELECT 'paths', NULL, user_path, NULL, count(ClientID) FROM segs GROUP BY user_path "
            "UNION ALL SELECT 'goals', NULL, CAST(goal AS VARCHAR), NULL, count(ClientID) FROM flags GROUP BY goal "
            "UNION ALL SELECT 'conversions', NULL, CASE WHEN conv THEN 'get@conv' ELSE 'get@no_conv' END, NULL, count(ClientID) FROM flags "
            "WHERE ClientID IN (SELECT ClientID FROM flags WHERE qual) GROUP BY conv")),
        "report_by_window": (
            f"SELECT *, 'success' AS report_window FROM ({_paths_sql('canonical', _AGG)}) "
            f"UNION ALL SELECT *, 'fail' FROM ({_paths_sql('canonical_fail', _AGG)})"),
        "top_paths_from_config": _paths_sql("csv", top10),
        **{f"tied_{r}_detail": _paths_sql(r, _DETAIL, hits=_TIED_CTE, sources=_TIED_SOURCES) for r in _RULES},
        **{f"tied_{r}_agg": _paths_sql(r, _AGG, hits=_TIED_CTE, sources=_TIED_SOURCES) for r in _RULES},
        **{f"tied_{r}_pivot": _paths_sql(r, _PIVOT, "both", "all", hits=_TIED_CTE, sources=_TIED_SOURCES)
           for r in _RULES if r != "canonical_fail"},
    }
