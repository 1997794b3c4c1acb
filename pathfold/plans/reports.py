"""Reports: path detail, path counts, success/fail pivot, top paths, diagnostics.

Each function takes the hit log (any DataFrame in hit schema) and the job
parameters and returns a lazy DataFrame; nothing is collected.
"""
from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.goals import conversion_mark, tagged_touch
from ..operators import clients as client_sets
from ..operators.channels import channel_numbers
from ..operators.segments import segments
from ..constants import TRANSIT_ACTION
from ..operators.sequence import Overview, history, overview, sequence
from ..params import JobParams
from .variants import CANONICAL, CSV_ERA, V2, Variant, scope


def _scoped(hits: DataFrame, params: JobParams, variant: Variant) -> tuple[DataFrame, Callable[[DataFrame, str], DataFrame]]:
    """The variant's hits, with channels as numbers if the job asks for it and
    there are few enough, and what makes text of a path column."""
    scoped = scope(hits, params, variant)
    numbers = channel_numbers(scoped) if params.channel_numbers else None
    if numbers is None:
        return scoped, lambda df, _: df
    return numbers.numbered(scoped), lambda df, path: df.withColumn(path, numbers.text(F.col(path)))


def _numbered(scoped: DataFrame) -> bool:
    return scoped.schema["channel"].dataType.simpleString() == "int"


def _segments(scoped: DataFrame, params: JobParams, variant: Variant, mode: str | None = None, clients: str | None = None,
              timeline: bool = True, seen: Overview | None = None) -> DataFrame:
    d_mode, d_clients = variant.selection(params)
    clients = clients or d_clients
    found = history(scoped, params.heavy_share, params.heavy_rows, clients, seen)
    return segments(found, mode=mode or d_mode, clients=clients, trim=variant.trim, timeline=timeline, numbered_channels=_numbered(scoped))


def path_segments(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL,
                  mode: str | None = None, clients: str | None = None,
                  timeline: bool = True, seen: Overview | None = None) -> DataFrame:
    """Kept paths: ClientID, seg, user_path, [timeline,] status, n_touches."""
    scoped, with_text = _scoped(hits, params, variant)
    return with_text(_segments(scoped, params, variant, mode, clients, timeline, seen), "user_path")


def detail_report(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL, seen: Overview | None = None) -> DataFrame:
    """One row per client path: ClientID, user_path, timeline, target_numbers."""
    return (path_segments(hits, params, variant, seen=seen)
            .select("ClientID", "user_path", "timeline",
                    F.lit(params.targets_csv).alias("target_numbers")))


def aggregate_report(detail: DataFrame) -> DataFrame:
    """Clients per distinct path, most frequent first (path breaks ties), from
    a detail report that is built anyway (the job runner)."""
    return (detail.groupBy("user_path").agg(F.count("ClientID").alias("count"))
            .orderBy(F.desc("count"), F.asc("user_path")))


def path_counts(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> DataFrame:
    """The aggregate report straight from the hits, without building timelines."""
    scoped, with_text = _scoped(hits, params, variant)
    counts = _segments(scoped, params, variant, timeline=False).groupBy("user_path").agg(F.count("ClientID").alias("count"))
    return with_text(counts, "user_path").orderBy(F.desc("count"), F.asc("user_path"))


def status_pivot(hits: DataFrame, params: JobParams, variant: Variant = V2) -> DataFrame:
    """paths, true, false, share: success / fail counts per path (null, not 0,
    when a path never has that status) and the path's share of all success
    paths.  Every conversion that the look-back cut leaves closes exactly one
    success path, so the history's own aggregate knows their total."""
    scoped, with_text = _scoped(hits, params, variant)
    found = history(scoped, params.heavy_share, params.heavy_rows)
    segs = segments(found, mode="both", clients="all", trim=variant.trim, timeline=False, numbered_channels=_numbered(scoped))
    total = F.lit(found.n_conv - found.n_pre)
    counts = segs.groupBy(F.col("user_path").alias("paths")).agg(
        F.sum(F.when(F.col("status"), F.lit(1))).alias("true"),
        F.sum(F.when(~F.col("status"), F.lit(1))).alias("false"))
    return (with_text(counts, "paths").select("paths", "true", "false",
                          F.try_divide(F.col("true").cast("double"), total).alias("share"))
            .orderBy(F.desc("true"), F.asc("paths")))


def top_paths(hits: DataFrame, params: JobParams, k: int = 10, variant: Variant = CSV_ERA) -> DataFrame:
    """The ``k`` most frequent success paths (utm-source channels): paths, count."""
    scoped, with_text = _scoped(hits, params, variant)
    segs = _segments(scoped, params, variant, "success", "all", timeline=False)
    counts = segs.groupBy(F.col("user_path").alias("paths")).agg(F.count(F.lit(1)).alias("count"))
    return (with_text(counts, "paths")
            .orderBy(F.desc("count"), F.asc("paths")).limit(k))


# -- intermediate views -------------------------------------------------------

def selected_hits(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> DataFrame:
    """Hits of the clients the report keeps (converters or non-converters)."""
    scoped = scope(hits, params, variant)
    _, clients = variant.selection(params)
    if clients == "converters":
        return client_sets.converter_hits(scoped)
    if clients == "nonconverters":
        return client_sets.nonconverter_hits(scoped)
    return scoped


def client_sequences(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> DataFrame:
    """Every scoped hit with its position ``rn`` in its client's history,
    its segment ``seg`` and its tagged touch."""
    seq = sequence(scope(hits, params, variant), params.heavy_share, params.heavy_rows)
    return seq.select("ClientID", "HitTimeStamp", "channel", "conv", "rn", "seg",
                      tagged_touch(F.col("channel"), F.col("conv"), variant.old_marks).alias("channel_conv"))


def lookback_trim(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> DataFrame:
    """Hits of the selected clients that survive the look-back cut."""
    _, clients = variant.selection(params)
    seq = sequence(scope(hits, params, variant), params.heavy_share, params.heavy_rows, clients)
    keep = F.col("seg") >= F.col("client_pre")
    if clients == "converters":
        keep = keep & (F.col("client_qual") > 0)
    elif clients == "nonconverters":
        keep = keep & (F.col("client_qual") == 0)
    return seq.filter(keep).select("ClientID", "HitTimeStamp", "channel", "conv", "rn")


def job_overview(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> Overview:
    """The one aggregate that a path job runs before its report: what the report
    needs (see ``sequence.overview``) and what both diagnostics tell."""
    every_client = dataclasses.replace(variant, keep_null_client=True)
    _, clients = variant.selection(params)
    # the normalised goals there can be; where goals are not filtered, there can be any
    goals = () if variant.goal_rule == "erase" else (*dict.fromkeys((*params.target_numbers, TRANSIT_ACTION)),)
    return overview(scope(hits, params, every_client), clients, goals, null_is_client=variant.keep_null_client)


def goal_counts_seen(spark: SparkSession, seen: Overview) -> DataFrame:
    """``goal_counts`` from the job's overview."""
    rows = [(goal, n_clients) for goal, (n, n_clients) in seen.goals.items() if n]
    return spark.createDataFrame(rows, "goal bigint, count bigint")


def conversion_counts_seen(spark: SparkSession, seen: Overview, variant: Variant = CANONICAL) -> DataFrame:
    """``conversion_counts`` from the job's overview, for variants without a null client."""
    counts = spark.createDataFrame([(True, seen.kept_conv), (False, seen.kept_hits - seen.kept_conv)], "conv boolean, count bigint")
    return counts.where("count > 0").select(conversion_mark(F.col("conv"), variant.old_marks).alias("conversion"), "count")


def goal_counts(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> DataFrame:
    """Hits per normalised goal (a diagnostic of the canonical job); counted
    before client selection, so a null client's hits form groups but add 0."""
    every_client = dataclasses.replace(variant, keep_null_client=True)
    return scope(hits, params, every_client).groupBy("goal").agg(F.count("ClientID").alias("count"))


def conversion_counts(hits: DataFrame, params: JobParams, variant: Variant = CANONICAL) -> DataFrame:
    """Hits of the selected clients per conversion mark."""
    sel = selected_hits(hits, params, variant)
    return (sel.groupBy(conversion_mark(F.col("conv"), variant.old_marks).alias("conversion"))
            .agg(F.count("ClientID").alias("count")))
