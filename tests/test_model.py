"""Property test: the window plans equal a walk by hand, with and without cutting clients into chunks."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import string_model
from hitlog import HIT_DDL, hit
from pathfold import JobParams
from pathfold.constants import HIT_COLUMNS
from pathfold.plans import V2, reports

NAMES = [n for n, _ in HIT_COLUMNS]

hit_st = st.builds(
    lambda c, ch, ts, g, proj, src: hit(c, ch, ts, g, project=proj, src=src),
    st.sampled_from(["a", "b", "c", None]), st.sampled_from(list("ABCD")),
    st.integers(0, 60), st.sampled_from([None, None, 3, 5, 7, -1]),
    st.sampled_from([1, 1, 1, 2]), st.sampled_from(["ga", "ga", "bq", "foo"]))

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _params(mode, share, start=20, width=30, back=15):
    return JobParams(project_id=1, date_start=start, date_finish=start + width,
                     date_lookback=max(0, start - back), target_numbers=(3, 5),
                     source_platform=("ga", "bq"), achieve_mode=mode, heavy_share=share,
                     heavy_rows=1 if share else 50_000)


@SETTINGS
@given(st.lists(hit_st, min_size=1, max_size=40), st.sampled_from(["true", "false"]),
       st.sampled_from([None, 3, 10, 1000]),
       st.integers(0, 40), st.integers(1, 40), st.integers(0, 20))
def test_canonical_matches_model(spark, rows, mode, share, start, width, back):
    p = _params(mode, share, start, width, back)
    df = spark.createDataFrame(rows, HIT_DDL).repartition(3)
    got = sorted((r.ClientID, r.user_path, r.timeline) for r in reports.detail_report(df, p).collect())
    expected = string_model.canonical([dict(zip(NAMES, r)) for r in rows], p)
    assert got == expected


@SETTINGS
@given(st.lists(hit_st, min_size=1, max_size=40), st.sampled_from([None, 4, 1000]))
def test_pivot_matches_model(spark, rows, share):
    p = _params("true", share)
    df = spark.createDataFrame(rows, HIT_DDL).repartition(2)
    got = {r.paths: (r["true"], r["false"], r.share) for r in reports.status_pivot(df, p, V2).collect()}
    expected = string_model.v2_pivot([dict(zip(NAMES, r)) for r in rows], p)
    assert set(got) == set(expected)
    for k, (t, f, s) in expected.items():
        gt, gf, gs = got[k]
        assert (gt, gf) == (t, f)
        assert (gs is None and s is None) or abs(gs - s) < 1e-12


@SETTINGS
@given(st.lists(hit_st, min_size=1, max_size=40), st.sampled_from([None, 5, 1000]))
def test_v3_and_null_match_model(spark, rows, share):
    from pathfold.plans import NULL, V3
    p = _params("true", share)
    df = spark.createDataFrame(rows, HIT_DDL).repartition(2)
    dicts = [dict(zip(NAMES, r)) for r in rows]
    got_v3 = sorted((r.ClientID, r.user_path, r.timeline) for r in reports.detail_report(df, p, V3).collect())
    assert got_v3 == string_model.v3(dicts, p)
    got_null = sorted((r.ClientID, r.user_path, r.timeline) for r in reports.detail_report(df, p, NULL).collect())
    assert got_null == string_model.null_report(dicts, p)
