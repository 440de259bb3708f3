"""Message source over the driver's ``events`` table.

The order producer of the original setup is an external process; here purchase events
are replayed as a file stream and turned into order messages with a binary JSON
``body`` column - the same shape a message-queue source yields. Any streaming
DataFrame with a payload column can take its place (``payload_col`` of
``parse_orders``), e.g. ``readStream.format("kafka")`` with ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.fixtures import Fixtures


def event_stream(fx: Fixtures) -> DataFrame:
    """The events table, a Parquet file or a folder of part files, as a stream (schema
    taken from the file footers). A stream takes a single file only by a glob."""
    schema = fx.table("events").schema
    return fx.spark.readStream.schema(schema).parquet(f"{fx.sf_dir}/events.parque[t]")


PARTITIONS = 4      # of the replayed queue


def as_messages(orders: DataFrame) -> DataFrame:
    """Orders as queue messages: ``body`` (JSON bytes) and where and when it was queued.

    The replayed queue deals event ids round robin over its partitions and takes each
    order in one second after its time."""
    event = F.expr("order_id div 2")
    body = F.to_json(F.struct(*[F.col(c) for c in orders.columns])).cast("binary")
    return orders.select(
        body.alias("body"),
        F.expr("try_to_timestamp(timestamp) + INTERVAL '1' SECOND").alias("enqueued_at"),
        F.pmod(event, F.lit(PARTITIONS)).cast("int").alias("message_partition"),
        F.expr(f"order_id div 2 div {PARTITIONS}").alias("message_offset"))


def order_messages(fx: Fixtures) -> DataFrame:
    """Streaming order messages of the replayed events."""
    return as_messages(fx.stream_orders_from(event_stream(fx)))


def kafka_messages(spark, bootstrap_servers: str, topic: str,
                   starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                   options: dict[str, str] | None = None) -> DataFrame:
    """Order messages from a Kafka-protocol endpoint: ``body`` and the columns of
    ``schemas.MESSAGE`` (time, partition and offset of the queue).

    ``options`` carries the security settings (``kafka.security.protocol``,
    ``kafka.sasl.mechanism``, ``kafka.sasl.jaas.config``, timeouts) unchanged; secrets
    are the caller's to supply. Needs the ``spark-sql-kafka`` package on the classpath.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    try:
        raw = reader.load()
    except Exception as e:  # connector missing: say what to add
        if "kafka" in str(e).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka package "
                               "(spark.jars.packages)") from e
        raise
    return raw.select(F.col("value").alias("body"), F.col("timestamp").alias("enqueued_at"),
                      F.col("partition").alias("message_partition"),
                      F.col("offset").alias("message_offset"))
