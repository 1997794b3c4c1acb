"""Client sets and selection, null client included (V2 scope keeps it)."""
from hitlog import hits_df, micro_rows
from pathfold import JobParams
from pathfold.operators import clients as client_sets
from pathfold.plans import CANONICAL, V2, scope

PARAMS = JobParams(project_id=1, date_start=100, date_finish=200, date_lookback=0,
                   target_numbers=(3, 5), source_platform=("ga",))


def _ids(df):
    return sorted((r.ClientID for r in df.collect()), key=lambda c: (c is not None, c))


def test_sets_with_a_null_client(spark):
    scoped = scope(hits_df(spark, micro_rows()), PARAMS, V2)
    assert _ids(client_sets.converters(scoped)) == [None, "c1", "c4", "c6", "c8"]
    # EXCEPT semantics: all clients minus converters
    assert _ids(client_sets.nonconverters(scoped)) == ["c3", "c5"]
    # joins never match a null id
    assert {r.ClientID for r in client_sets.converter_hits(scoped).collect()} == {"c1", "c4", "c6", "c8"}
    assert {r.ClientID for r in client_sets.nonconverter_hits(scoped).collect()} == {"c3", "c5"}


def test_canonical_scope_drops_null_client(spark):
    scoped = scope(hits_df(spark, micro_rows()), PARAMS, CANONICAL)
    assert None not in _ids(client_sets.converters(scoped))
    # c2's only conversion is before the start: not a converter, but a client
    assert _ids(client_sets.nonconverters(scoped)) == ["c2", "c3", "c5"]
