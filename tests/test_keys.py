from pyspark.sql import functions as F

import pytest
from soukline.operators import dedup_by_key, unique_or_error, with_sequential_id


def test_dedup_hot_key_is_deterministic(spark):
    # one key holds a third of all rows
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 37 % 1000).alias("v"), F.col("id").alias("w"))
    out = dedup_by_key(df.repartition(8), ["k"], order_by=["v"], keep="last")
    assert out.count() == df.select("k").distinct().count()
    hot = out.filter("k = 7").first()
    expect = (df.filter("k = 7").orderBy(F.col("v").desc(), F.col("w").desc()).first())
    assert (hot.v, hot.w) == (expect.v, expect.w)
    # the plan folds copies on the map side (partial + final aggregate)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") >= 2


def test_sequential_id_dense_and_ordered(spark):
    cities = spark.createDataFrame([(c,) for c in ["Pune", "Agra", "Goa", "Delhi", "Kochi",
                                                   "Surat", "Patna"]], "city string")
    out = with_sequential_id(cities.repartition(3), ["city"], "location_id")
    got = sorted((r.location_id, r.city) for r in out.collect())
    assert got == list(enumerate(sorted(["Pune", "Agra", "Goa", "Delhi", "Kochi", "Surat",
                                         "Patna"]), start=1))
    shifted = with_sequential_id(cities, ["city"], "location_id", start=11)
    assert sorted(r.location_id for r in shifted.collect()) == list(range(11, 18))


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_sequential_id_of_wide_rows(spark, reuse):
    # two columns and many rows: sizes and ids must come from one range partitioning
    n = 300_000
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(n).select((F.col("id") * 7919 % 1000).alias("a"), F.col("id").alias("b"),
                                   F.repeat(F.lit("x"), 40).alias("c"))
        out = with_sequential_id(df.repartition(16), ["a", "b"], "rank")
        got = out.agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"),
                      F.min("rank").alias("lo"), F.max("rank").alias("hi")).first()
        assert tuple(got) == (n, n, 1, n)
        one = out.filter("a = 500").agg(F.min("rank"), F.max("rank"), F.count("*")).first()
        assert one[1] - one[0] + 1 == one[2]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_unique_or_error(spark):
    ok = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert unique_or_error(ok, ["k"]).count() == 4
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="more than one source row"):
        unique_or_error(twice, ["k"]).collect()
