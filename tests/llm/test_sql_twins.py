"""Queries with a DuckDB twin, on the smallest tables."""

import pytest

from compare import diff, duck, run_oracle
from trackwise.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    got = QUERIES[key](spark, SF).toPandas()
    assert len(got) > 0
    assert diff(got, run_oracle(duck(SF), ORACLE[key])) == []
