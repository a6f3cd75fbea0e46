"""The queries that SQL can express equal their DuckDB SQL at sf0.01; the others run there whole."""

import pytest

from tests.oracle_compare import compare
from tidewater.llm.oracle import SQL
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    (r,) = compare(spark, SF, [name]).values()
    assert "error" not in r and r["match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs_over_its_table(spark, name):
    rows = QUERIES[name](spark, SF).count()
    whole = {"op4_license_scan": None, "op6_url_filter": 250}.get(name, 1000)
    assert rows > 0 if whole is None else rows == whole
