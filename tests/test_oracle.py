"""Every registered query against its DuckDB oracle on the smallest data."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bucketvote.plans.registry import QUERIES

from .compare import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(smoke_dir):
    return duck(smoke_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 0
    assert df.columns == ["a_id", "b_id", "votes"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, smoke_dir, key):
    res = compare(spark, con, smoke_dir, key, queries()[key], oracle_sql().get(key))
    assert res["status"] == "ok", res
