"""Plan-shape checks: no Python UDFs, pushdown and pruning reach the scans."""

import pytest

from conftest import SF_SMALL
from soukline.plans import registry

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
            "FlatMapGroupsInPandas")
BATCH = sorted(n for n in registry.queries() if not n.startswith("stream_")
               and n != "csv_roundtrip_infer")


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_python_and_reads_the_given_tables(spark, name):
    plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PY_NODES), name
    assert any(f"Scan {fmt}" in plan for fmt in ("parquet", "json", "csv")), name
    # the given tables, or files Spark derived from them in the shared folder
    assert SF_SMALL.rstrip("/").split("/")[-1] in plan or "soukline" in plan, name


@pytest.mark.parametrize("name", ["fact_orders_gold", "fact_live_gold"])
def test_facts_are_not_shuffled_on_city(spark, name):
    plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # the fact moves once, for its de-duplication; stored dimensions are broadcast by size
    assert "hashpartitioning(city" not in plan and "SortMergeJoin" not in plan


def test_months_prune_bronze_orders(spark):
    from pyspark.sql import functions as F
    from soukline.plans import flows
    from soukline.plans.fixtures import Fixtures
    from soukline.session import run_dir
    from soukline.sources.tables import append_new_keys
    path = run_dir(spark, "t-bronze")
    orders = flows.with_month(Fixtures(spark, SF_SMALL).orders, "order_time")
    append_new_keys(orders, path, ["order_id"], flows.MONTH)
    df = flows._months(spark.read.parquet(path), ["1996-01"]).select(F.sum("amount"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "order_month" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_filter_and_projection_reach_the_scan(spark):
    from soukline.plans.fixtures import Fixtures
    from pyspark.sql import functions as F
    fx = Fixtures(spark, SF_SMALL)
    df = fx.table("lineitem").filter(F.col("l_quantity") > 10).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_library_has_no_collect_or_udf():
    import pathlib
    src = pathlib.Path(__file__).resolve().parents[1] / "soukline"
    for p in src.rglob("*.py"):
        if p.parent.name == "llm":      # has its own tests
            continue
        text = p.read_text()
        for bad in (".collect()", "toPandas(", "@udf", "pandas_udf", ".rdd.", "localCheckpoint"):
            assert bad not in text, f"{bad} in {p}"
