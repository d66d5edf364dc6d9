"""Registered queries against their SQL, over whole tables."""

import pytest
from check_oracles import compare, connect

from tidebar.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF), SF, queries()[name], oracle_sql()[name]) is None
