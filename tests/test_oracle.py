"""The correctness gate: every registered query equals its DuckDB SQL at sf0.01."""

import pytest

from __spark_entry__ import entry
from tests.oracle_compare import compare
from tidewater.plans.oracle import SQL
from tidewater.plans.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(SQL)


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, list(REGISTRY))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(results, name):
    r = results[name]
    assert "error" not in r, r
    assert r["match"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["docentry", "linenum", "itemcode", "quantity", "linetotal", "_ingested_at"]
