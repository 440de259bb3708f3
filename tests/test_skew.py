"""Hot keys: a third of all rows on one key must not end up in one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from soukline.operators import join_weather


@pytest.fixture
def skew_conf(spark):
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_weather_join_splits_a_hot_key(spark, skew_conf):
    n = 60000
    day = dt.date(2024, 1, 5)
    hot = F.col("id") % 3 == 0
    orders = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(hot, F.lit("Pune")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50)
                                                      .cast("string"))).alias("city"),
        F.lit(day).alias("order_date"),
        F.when(hot, F.lit(10)).otherwise((F.col("id") % 24).cast("int")).alias("order_hour"))
    weather = (spark.range(50).select(F.concat(F.lit("c"), F.col("id").cast("string"))
                                      .alias("city"))
               .union(spark.createDataFrame([("Pune",)], "city string"))
               .withColumn("order_date", F.lit(day))
               .withColumn("order_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
               .withColumn("temperature", F.lit(21.0))
               .withColumn("weather_condition", F.lit("Clear Sky"))
               .withColumn("wind_speed", F.lit(1.0)).withColumn("humidity", F.lit(50)))
    out = join_weather(orders, weather)
    rows = out.collect()                                 # runs this DataFrame's own plan
    assert len(rows) == n                                # whole result, nothing dropped
    assert all(r.temperature == 21.0 for r in rows)
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "skew=true" in final, final[:3000]
