"""Queries with a DuckDB statement, on the small test data; registration and plans."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from soukline.llm import queries  # noqa: E402

SMALL = "/root/testdata/sf0.001"
NATIVE = ["op1_exact_dedup", "op2_mix_sources", "op3_chat_format", "op10_url_rules"]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, name):
    assert compare(spark, name, SMALL, duck(SMALL))["status"] == "ok"


def test_all_operators_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_no_local_checkpoint_or_pandas_collect():
    root = pathlib.Path(queries.__file__).parent
    for p in root.glob("*.py"):
        for bad in ("localCheckpoint", "toPandas(", "mkdtemp"):
            assert bad not in p.read_text(), (p, bad)
