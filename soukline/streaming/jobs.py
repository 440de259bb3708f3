"""Streaming jobs of the order flow, and their registered queries.

bronze:  order messages --parse--> append into the buffer folder (checkpointed)
silver:  buffer stream --clean--> foreachBatch: weather/rate joins, upsert
gold:    buffer stream --clean--> foreachBatch: joins + star joins with stored dims, upsert
merge:   buffer stream --foreachBatch insert-only--> bronze orders (checkpoint = drain)
live:    buffer stream --foreachBatch insert-only--> order store --differences--> totals

Each registered query runs ``availableNow`` in a fresh folder under the session's shared
checkpoint directory and returns a batch read of what the job wrote.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timekeys import with_time_keys
from ..operators.clean import align_stream_orders
from ..operators.enrich import enrich_orders
from ..operators.star import fact_live
from ..plans.fixtures import Fixtures, LandedFixtures
from ..operators.merge import upsert
from ..plans.flows import LakePaths, MONTH, land_messages, read_fact, with_month
from ..plans.oracle import AS_OF_TS
from ..schemas import BUFFER_SCHEMA, MESSAGE, MESSAGE_ORDER, STREAM_ORDER
from ..session import drop_dir, ensure_conf, run_dir, saved
from ..sources.tables import (apply_first, first_changes, merge_partitions, path_exists,
                              read_table, read_table_or_none, write_version)
from .ingest import (await_done, parse_orders, start_append, start_batches, start_insert_only,
                     start_upsert)
from .source import as_messages, event_stream, order_messages

BUFFER_COLUMNS = [*STREAM_ORDER.fieldNames(), *MESSAGE_ORDER]


def land_buffer(fx: Fixtures, root: str, as_of=None) -> str:
    """R1+R2: parse the order messages and append them to ``<root>/bronze_stream``."""
    path = f"{root}/bronze_stream"
    q = start_append(parse_orders(order_messages(fx), as_of=as_of), path,
                     f"{root}/_checkpoints/bronze_stream")
    await_done(q)
    return path


def buffer_stream(spark: SparkSession, root: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The buffer folder as a stream (reads the sink's committed-file log).

    ``max_files_per_trigger`` bounds the size of each micro-batch."""
    r = spark.readStream.schema(BUFFER_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{root}/bronze_stream")


def clean_order_stream(buffer: DataFrame) -> DataFrame:
    """Stateless cleaning on the stream; the key de-duplication happens per batch."""
    return (with_time_keys(align_stream_orders(buffer, keep=tuple(MESSAGE_ORDER)), "order_time")
            .filter(F.col("order_id").isNotNull() & (F.col("amount") > 0)))


def q_stream_parse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(ensure_conf(spark), "stream-append")
    path = land_buffer(Fixtures(spark, sf_dir), root)
    return spark.read.parquet(path).select(*BUFFER_COLUMNS)


def q_stream_restart_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(ensure_conf(spark), "stream-restart")
    fx = Fixtures(spark, sf_dir)
    land_buffer(fx, root)
    path = land_buffer(fx, root)          # same checkpoint: must add nothing
    return spark.read.parquet(path).select(*BUFFER_COLUMNS)


def q_stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The always-on form of the landing job: a processing-time trigger, stopped when the
    source has nothing more, then a restart on the same checkpoint."""
    root = run_dir(ensure_conf(spark), "stream-trigger")
    fx = Fixtures(spark, sf_dir)
    path = f"{root}/bronze_stream"
    for _ in range(2):
        q = start_append(parse_orders(order_messages(fx)), path, f"{root}/_checkpoints/bronze",
                         {"processingTime": "1 second"}, name=f"landing-{uuid4().hex[:8]}")
        q.processAllAvailable()
        q.stop()
    return spark.read.parquet(path).select(*BUFFER_COLUMNS)


def q_stream_enrich_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(ensure_conf(spark), "stream-silver")
    fx = LandedFixtures(spark, sf_dir)
    land_buffer(fx, root)
    table = f"{root}/silver_fact_streaming_orders"
    weather, currency = fx.weather, fx.currency
    # the stream plan stays stateless; the weather/rate joins run per micro-batch
    await_done(start_upsert(
        clean_order_stream(buffer_stream(spark, root)), table, ["order_id"],
        f"{root}/_checkpoints/silver", partition_col=MONTH, order_by=["order_time"],
        transform=lambda b: with_month(enrich_orders(b, weather, currency))))
    return read_fact(spark, table)


def q_stream_live_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buffer -> stored silver stream fact -> live fact, with stored dimensions."""
    from ..plans.registry import Lake
    root = run_dir(ensure_conf(spark), "stream-gold")
    lake = Lake.of(spark, sf_dir)
    land_buffer(lake.fx, root)
    silver = f"{root}/silver_fact_streaming_orders"
    await_done(start_upsert(
        clean_order_stream(buffer_stream(spark, root)), silver, ["order_id"],
        f"{root}/_checkpoints/silver", partition_col=MONTH, order_by=["order_time"],
        transform=lambda b: with_month(enrich_orders(b, lake.weather, lake.currency))))
    live = fact_live(read_fact(spark, silver), lake.dim_products, lake.dim_location,
                     lake.dim_date, as_of=AS_OF_TS)
    table = f"{root}/gold_fact_streaming_orders"
    merge_partitions(with_month(live), table, ["order_id"], MONTH, upsert)
    return read_fact(spark, table)


def q_stream_merge_then_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(ensure_conf(spark), "stream-merge")
    fx = Fixtures(spark, sf_dir)
    buffer_path = land_buffer(fx, root)
    # bronze orders: partitioned by order month; a batch checks its keys against the key
    # column of all months and appends the new ones, rewriting nothing
    orders = f"{root}/bronze_orders"
    before = fx.orders.count()
    never_queued = {f.name: F.lit(None).cast(f.dataType) for f in MESSAGE.fields}
    batch = with_month(fx.orders.withColumns(never_queued), "order_time")
    batch.write.partitionBy(MONTH).parquet(orders)
    aligned = with_month(align_stream_orders(buffer_stream(spark, root),
                                             keep=tuple(MESSAGE_ORDER)), "order_time")
    ckpt = f"{root}/_checkpoints/merge"
    how = {"partition_col": MONTH, "order_by": MESSAGE_ORDER}
    await_done(start_insert_only(aligned, orders, ["order_id"], ckpt, **how))
    rerun: list[int] = []                 # a second run sees nothing: the buffer is drained
    await_done(start_insert_only(aligned, orders, ["order_id"], ckpt, seen=rerun, **how))
    tagged = (spark.read.parquet(buffer_path).select(F.lit(2).alias("t"))
              .unionByName(read_fact(spark, orders).select(F.lit(3).alias("t"))))
    counts = tagged.agg(F.count_if(F.col("t") == 2).alias("buffered"),
                        F.count_if(F.col("t") == 3).alias("after"))
    return counts.select(F.lit(before).cast("bigint").alias("batch_before"), "buffered",
                         (F.col("after") - F.lit(before)).alias("added"), "after",
                         F.lit(sum(rerun)).cast("bigint").alias("buffer_after"))


def _last_batch(totals: DataFrame | None) -> int:
    row = totals.agg(F.max("last_batch")).first() if totals is not None else None
    return -1 if row is None or row[0] is None else row[0]


def live_by_hour(spark: SparkSession, buffer: DataFrame, root: str) -> DataFrame:
    """Orders per hour over everything the stream has brought, however late, kept up by
    the difference each batch makes.

    A batch's orders that are new, or earlier in the queue than the stored message of
    their id, go into a store (by month; only its key range near the batch's is read).
    New orders count one more for their hour, a message that gave way one less for its
    own; these differences are added to the stored totals, a row per hour, which carry
    the number of the last batch. A replay finds its changes where the first try left
    them and adds them to the totals once. No watermark drops rows.
    """
    store, table = f"{root}/live_orders", f"{root}/live_by_hour"

    def update(batch: DataFrame, batch_id: int) -> None:
        totals = read_table_or_none(spark, table)
        if _last_batch(totals) >= batch_id:         # counted; the store was changed before
            return
        kept = f"{root}/_changes/{batch_id}"
        if not path_exists(spark, f"{kept}/_SUCCESS"):
            rows = with_month(batch.select("order_id", "order_date", "order_hour",
                                           *MESSAGE_ORDER)).drop("order_date")
            changes = first_changes(saved(rows, f"{root}/_rows/{batch_id}-{uuid4().hex}"),
                                    store, ["order_id"], MESSAGE_ORDER)
            changes.write.mode("overwrite").parquet(kept)
        changes = spark.read.parquet(kept)
        apply_first(changes, store, ["order_id"], MONTH)
        more = changes.select("order_hour", F.lit(1).cast("long").alias("orders"))
        less = changes.filter("_old IS NOT NULL").select(
            F.col("_old.order_hour").alias("order_hour"), F.lit(-1).cast("long").alias("orders"))
        parts = more.unionByName(less)
        if totals is not None:
            parts = parts.unionByName(totals.select("order_hour", "orders"))
        write_version(parts.groupBy("order_hour").agg(F.sum("orders").alias("orders"))
                      .withColumn("last_batch", F.lit(batch_id).cast("long")), table, keep=3)
        for used in ("_changes", "_rows"):
            drop_dir(spark, f"{root}/{used}")

    await_done(start_batches(buffer, update, f"{root}/_checkpoints/hourly"))
    return read_table(spark, table).filter("orders > 0").select("order_hour", "orders")


def q_stream_live_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(ensure_conf(spark), "stream-hourly")
    fx = Fixtures(spark, sf_dir)
    # three files, so three micro-batches whose order times overlap
    rows = parse_orders(as_messages(fx.stream_orders), as_of=AS_OF_TS)
    rows.repartition(3, "order_id").write.parquet(f"{root}/bronze_stream")
    return live_by_hour(spark, clean_order_stream(buffer_stream(spark, root, 1)), root)


def q_stream_first_message_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that disagree about an order id, some queued earlier in another partition:
    the table after one batch and after many, beside batch orders that stay as they are."""
    root = run_dir(ensure_conf(spark), "stream-first")
    fx = Fixtures(spark, sf_dir)
    sent = as_messages(fx.stream_orders)
    message = parse_orders(sent, as_of=AS_OF_TS)

    def again(part: DataFrame, amount: int, minutes: int) -> DataFrame:
        """Another message for the same ids, queued ``minutes`` later in a partition of its own."""
        return part.withColumns({
            "amount": (F.col("amount") + amount).cast(message.schema["amount"].dataType),
            "enqueued_at": F.expr(f"enqueued_at + INTERVAL '{minutes}' MINUTE"),
            "message_partition": F.lit(9)})

    every = (message.unionByName(again(message.filter("order_id % 6 = 0"), 5, 30))
             .unionByName(again(message.filter("order_id % 10 = 0"), 9, -30)))
    every = saved(every, f"{root}/messages")
    before = fx.orders.filter("order_id % 8 = 0").withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in MESSAGE.fields})
    out = None
    for cut, files in (("one", 1), ("many", 4)):
        every.repartition(files, F.xxhash64("order_id", "amount")).write.parquet(
            f"{root}/{cut}/bronze_stream")
        orders = f"{root}/{cut}/orders"
        with_month(before, "order_time").write.partitionBy(MONTH).parquet(orders)
        rows = align_stream_orders(buffer_stream(spark, f"{root}/{cut}", 1),
                                   keep=tuple(MESSAGE_ORDER))
        await_done(start_insert_only(with_month(rows, "order_time"), orders, ["order_id"],
                                     f"{root}/{cut}/checkpoint", partition_col=MONTH,
                                     order_by=MESSAGE_ORDER))
        part = read_fact(spark, orders).select(
            F.lit(cut).alias("cut"), "order_id", "customer_id", "amount", "city", "order_time",
            "source", "enqueued_at", "message_partition")
        out = part if out is None else out.unionByName(part)
    return out


def q_stream_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates and late rows over several micro-batches: the newest of an id stays."""
    root = run_dir(ensure_conf(spark), "stream-batches")
    rows = align_stream_orders(Fixtures(spark, sf_dir).stream_orders)

    def moved(part: DataFrame, amount: int, days: int) -> DataFrame:
        return part.withColumns({
            "amount": (F.col("amount") + amount).cast(rows.schema["amount"].dataType),
            "order_time": F.expr(f"order_time + INTERVAL '{days}' DAY")})

    updates = moved(rows.filter("order_id % 6 = 0"), 5, 40)
    late = moved(rows.filter("order_id % 10 = 0"), 9, -40)
    every = rows.unionByName(updates).unionByName(late)
    every.repartition(3).write.parquet(f"{root}/landing")
    stream = (spark.readStream.schema(every.schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{root}/landing"))
    table = f"{root}/orders"
    await_done(start_upsert(stream, table, ["order_id"], f"{root}/_checkpoints/orders",
                            partition_col=MONTH, order_by=["order_time"],
                            transform=lambda b: with_month(b, "order_time")))
    return read_fact(spark, table)


def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that don't parse: their bodies and the reason, in the side table."""
    root = run_dir(ensure_conf(spark), "stream-rejects")
    fx = Fixtures(spark, sf_dir)
    sent = as_messages(fx.stream_orders_from(event_stream(fx)))
    order = F.get_json_object(F.col("body").cast("string"), "$.order_id")
    body = F.when(order.cast("long") % 50 == 0, F.concat(F.lit("broken "), order).cast("binary"))
    lake = LakePaths(root)
    land_messages(spark, lake, sent.withColumn("body", F.coalesce(body, "body")), AS_OF_TS)
    return spark.read.parquet(lake("bronze", "streaming_rejects")).select(
        "body", "reason", "message_partition", "message_offset")


def q_lake_stream_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files and messages through every job of one lake, to the live KPIs."""
    from ..plans import flows, reports
    from ..sources.files import write_csv
    root = run_dir(ensure_conf(spark), "lake")
    fx, lake = LandedFixtures(spark, sf_dir), LakePaths(f"{root}/lake")
    csv = {"customers": fx.customers, "products": fx.products, "orders": fx.orders.drop("source")}
    dirs = {name: write_csv(df, f"{root}/landing/{name}") for name, df in csv.items()}
    weather_docs, rate_docs = fx.weather_docs, fx.rate_docs
    flows.ingest_csv(spark, lake, dirs, as_of=AS_OF_TS)
    flows.land_messages(spark, lake, order_messages(fx), AS_OF_TS)
    flows.merge_stream_orders(spark, lake)
    flows.bronze_to_silver(spark, lake, weather_docs, rate_docs, as_of=AS_OF_TS)
    flows.silver_to_gold(spark, lake, as_of=AS_OF_TS)
    flows.stream_to_silver(spark, lake, weather_docs, rate_docs, as_of=AS_OF_TS)
    flows.silver_to_live(spark, lake, as_of=AS_OF_TS)
    return reports.live_totals(read_fact(spark, lake("gold", "fact_streaming_orders")))


STREAM_QUERIES = {
    "stream_parse_append": q_stream_parse_append,
    "stream_restart_exactly_once": q_stream_restart_exactly_once,
    "stream_enrich_upsert": q_stream_enrich_upsert,
    "stream_live_fact": q_stream_live_fact,
    "stream_merge_then_drain": q_stream_merge_then_drain,
    "stream_live_by_hour": q_stream_live_by_hour,
    "stream_upsert_batches": q_stream_upsert_batches,
    "stream_processing_time": q_stream_processing_time,
    "stream_rejects": q_stream_rejects,
    "stream_first_message_wins": q_stream_first_message_wins,
    "lake_stream_end_to_end": q_lake_stream_end_to_end,
}
