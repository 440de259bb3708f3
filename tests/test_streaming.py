from pyspark.sql import functions as F

from soukline.streaming import parse_orders


def test_malformed_bodies(spark):
    raw = spark.createDataFrame(
        [("bad",), ('{"order_id":"x","city":"A"}',), ('{"order_id":99999999999}',),
         ('{"order_id":7,"amount":12.5,"timestamp":"2024-01-01 10:00:00"}',)], "s string")
    out = parse_orders(raw.select(F.col("s").cast("binary").alias("body")), as_of="2024-02-01")
    got = [(r.order_id, r.city, str(r.amount) if r.amount is not None else None)
           for r in out.collect()]
    assert got == [(None, None, None), (None, "A", None), (99999999999, None, None),
                   (7, None, "12.50")]
    assert out.count() == 4            # rows are kept, fields become NULL


def _land(spark, folder, messages):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    df.select(F.col("value").cast("binary").alias("value")).write.mode("append").parquet(folder)


def test_replayed_duplicates_and_processing_time_trigger(spark):
    import json
    from pyspark.sql import types as T
    from soukline.session import run_dir
    from soukline.sources.tables import read_table
    from soukline.streaming import await_done, start_upsert

    root = run_dir(spark, "t-stream")
    msg = lambda i, amt: json.dumps({"order_id": i, "customer_id": 1, "product_id": 2,  # noqa
                                     "amount": amt, "currency": "INR", "city": "Pune",
                                     "timestamp": "2024-01-05 10:00:00"})
    _land(spark, f"{root}/landing", [msg(1, 10.0), msg(2, 20.0), msg(2, 20.0)])
    schema = T.StructType([T.StructField("value", T.BinaryType())])
    raw = spark.readStream.schema(schema).parquet(f"{root}/landing")
    # Kafka-style payload column name
    parsed = parse_orders(raw, payload_col="value", as_of="2024-02-01").drop("ingested_at")
    q = start_upsert(parsed, f"{root}/orders", ["order_id"], f"{root}/ckpt",
                     trigger={"processingTime": "1 second"})
    q.processAllAvailable()
    _land(spark, f"{root}/landing", [msg(2, 25.0), msg(3, 30.0)])   # a change and a new id
    q.processAllAvailable()
    q.stop()
    got = {r.order_id: str(r.amount) for r in read_table(spark, f"{root}/orders").collect()}
    assert got == {1: "10.00", 2: "25.00", 3: "30.00"}
    # restart on the same checkpoint: nothing is processed twice
    q2 = start_upsert(parsed, f"{root}/orders", ["order_id"], f"{root}/ckpt")
    await_done(q2, 120)
    assert read_table(spark, f"{root}/orders").count() == 3


def test_rejected_messages_keep_their_body(spark):
    from soukline.streaming import rejected_messages
    raw = spark.createDataFrame(
        [("bad",), ('{"order_id":1,"amount":-2,"timestamp":"2024-01-01 10:00:00"}',),
         ('{"order_id":2,"amount":3,"timestamp":"soon"}',),
         ('{"order_id":3,"amount":3,"timestamp":"2024-01-01 10:00:00"}',)], "body string")
    got = {r.body[:16]: r.reason for r in rejected_messages(raw).collect()}
    assert got == {"bad": "no order id", '{"order_id":1,"a': "amount not positive",
                   '{"order_id":2,"a': "no order time"}


def test_ids_above_two_to_the_31(spark):
    from soukline.operators import clean_orders, align_stream_orders
    raw = spark.createDataFrame([('{"order_id":3000000000,"customer_id":5000000000,'
                                  '"product_id":1,"amount":2.5,"currency":"INR","city":"Pune",'
                                  '"timestamp":"2024-01-01 10:00:00"}',)], "body string")
    row = clean_orders(align_stream_orders(parse_orders(raw))).first()
    assert (row.order_id, row.customer_id) == (3_000_000_000, 5_000_000_000)


def test_events_as_a_folder_of_files(spark, tmp_path):
    from soukline.plans.fixtures import Fixtures
    from soukline.streaming.jobs import land_buffer
    from conftest import SF_SMALL
    for t in ("customer", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    fx = Fixtures(spark, str(tmp_path))
    path = land_buffer(fx, str(tmp_path / "out"))
    assert spark.read.parquet(path).count() == fx.stream_orders.count() > 0


def test_queue_place_rides_along(spark):
    from pyspark.sql import functions as F
    from soukline.plans.fixtures import Fixtures
    from soukline.streaming.source import as_messages
    from conftest import SF_SMALL
    sent = as_messages(Fixtures(spark, SF_SMALL).stream_orders)
    out = parse_orders(sent)
    assert out.filter(F.col("enqueued_at").isNull() | F.col("message_offset").isNull()).isEmpty()
    assert out.select("message_partition").distinct().count() == 4
    place = out.groupBy("message_partition", "message_offset").count()
    assert place.filter("count > 1").isEmpty()
    # a source without these columns gives NULLs
    assert parse_orders(sent.select("body")).filter("message_offset IS NOT NULL").isEmpty()


def test_kafka_source_says_what_is_missing(spark):
    import pytest
    from soukline.streaming.source import kafka_messages
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka_messages(spark, "localhost:1", "orders")
