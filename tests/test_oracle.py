"""Every registered query against its DuckDB oracle on sf0.001."""
import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


#: the training-data queries have tests of their own, in tests/llm
OWN = sorted(k for k in E.queries() if k not in E._LLM_QUERIES)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, con)
    assert ok, msg
    assert not msg.startswith("0 rows"), "an empty result tells nothing"


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_path", "count"]
    assert df.count() > 0
