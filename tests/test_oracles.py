"""Every query against its SQL counterpart, over whole tables."""

import pytest
from check_oracles import compare, connect

from __spark_entry__ import entry
from tidebar.plans.oracles import oracle_sql
from tidebar.plans.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    from tidebar.schema import FEATURE_COLS

    df = entry(spark)
    assert df.columns == ["symbol", "date", "ts", *FEATURE_COLS]
    assert df.count() > 0
