"""Golden micro-fixture (FIXTURES.md section 2) through every report."""
import pytest

from hitlog import hits_df, letters, micro_rows
from pathfold import JobParams
from pathfold.plans import CSV_ERA, NULL, V2, V3, reports

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0,
                   target_numbers=(3, 5), source_platform=("ga",))
FAIL = JobParams(**{**PARAMS.__dict__, "achieve_mode": "false"})


def detail(spark, params, variant=None, partitions=None, **kw):
    p = JobParams(**{**params.__dict__, **kw})
    hits = hits_df(spark, micro_rows(), partitions)
    df = reports.detail_report(hits, p) if variant is None else reports.detail_report(hits, p, variant)
    return sorted((r.ClientID, letters(r.user_path), r.timeline) for r in df.collect())


SUCCESS = sorted([("c1", "B=>C=>D", "50=>110=>120"), ("c1", "E=>F", "130=>140"), ("c4", "A", "110"),
                  ("c4", "A", "111"), ("c6", "C", "199"), ("c8", "B", "106")])


def test_canonical_success(spark):
    assert detail(spark, PARAMS) == SUCCESS


def test_canonical_fail(spark):
    assert detail(spark, FAIL) == [("c3", "C=>D", "80=>110"), ("c5", "A", "150")]


def test_v3_success(spark):
    expected = sorted([r for r in SUCCESS if r[0] != "c8"] + [("c8", "A=>B", "105=>106")])
    assert detail(spark, PARAMS, V3) == expected


def test_null_fail(spark):
    assert detail(spark, PARAMS, NULL) == [("c3", "D=>E", "110=>115"), ("c5", "A=>B", "150=>160")]


def test_target_numbers_column(spark):
    hits = hits_df(spark, micro_rows())
    assert {r.target_numbers for r in reports.detail_report(hits, PARAMS).collect()} == {"3,5"}


def test_aggregate_canonical_success(spark):
    hits = hits_df(spark, micro_rows())
    agg = reports.aggregate_report(reports.detail_report(hits, PARAMS)).collect()
    assert [(letters(r.user_path), r["count"]) for r in agg] == [
        ("A", 2), ("B", 1), ("B=>C=>D", 1), ("C", 1), ("E=>F", 1)]


def test_pivot_v2(spark):
    hits = hits_df(spark, micro_rows())
    rows = reports.status_pivot(hits, PARAMS, V2).collect()
    got = {letters(r.paths): (r["true"], r["false"], r.share) for r in rows}
    assert got == {
        "A": (3, None, 3 / 7), "A=>B": (1, 1, 1 / 7), "C": (1, None, 1 / 7), "C=>D": (1, None, 1 / 7),
        "E=>F": (1, None, 1 / 7), "D": (None, 1, None), "G": (None, 1, None)}
    assert [letters(r.paths) for r in rows][0] == "A"          # true desc first
    assert [r["true"] for r in rows][-2:] == [None, None]      # nulls last


def test_pivot_without_success_paths(spark):
    """No conversion at all: the 'true' column exists and is null, share null."""
    from hitlog import hit
    hits = hits_df(spark, [hit("a", "A", 110), hit("a", "B", 120)])
    rows = reports.status_pivot(hits, PARAMS, V2).collect()
    assert [(letters(r.paths), r["true"], r["false"], r.share) for r in rows] == [("A=>B", None, 1, None)]


def test_top_paths_csv_era(spark):
    hits = hits_df(spark, micro_rows())
    rows = reports.top_paths(hits, PARAMS, 10, CSV_ERA).collect()
    # utm_source 's' everywhere: every success path is a run of 's'
    assert sum(r["count"] for r in rows) == 7
    assert rows[0].paths == "s" and rows[0]["count"] == 4


@pytest.mark.parametrize("share,partitions", [(None, 8), (3, 3), (10, 1), (1000, 5)])
def test_invariant_to_cuts_and_partitions(spark, share, partitions):
    kw = dict(partitions=partitions, heavy_share=share, heavy_rows=1 if share else 50_000)
    assert detail(spark, PARAMS, **kw) == SUCCESS
    assert detail(spark, FAIL, **kw) == [("c3", "C=>D", "80=>110"), ("c5", "A", "150")]


def test_diagnostics(spark):
    hits = hits_df(spark, micro_rows())
    goals = {r.goal: r["count"] for r in reports.goal_counts(hits, PARAMS).collect()}
    # canonical scope: goals 7 and -1 dropped, null -> -1, the null client not counted
    assert goals == {-1: 9, 3: 8, 5: 1}
    # hits of converters c1, c4, c6, c8 before the look-back cut
    conv = {r.conversion: r["count"] for r in reports.conversion_counts(hits, PARAMS).collect()}
    assert conv == {"get@conv": 7, "get@no_conv": 4}
