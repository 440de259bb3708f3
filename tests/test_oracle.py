"""Every registered query against its DuckDB oracle (sf0.001, order-insensitive)."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck

import __spark_entry__ as entry
from soukline.plans import oracle, registry

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(registry.queries())
    assert set(entry.queries()) >= set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "revenue_inr_thousands", "revenue_usd"]
    assert df.count() > 0
