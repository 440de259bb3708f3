"""Structured Streaming building blocks.

* ``parse_orders``     message payload (binary/JSON) -> typed order columns (R1)
* ``start_append``     checkpointed append into a Parquet folder (R2, exactly-once)
* ``start_upsert``     foreachBatch keyed merge into a copy-on-write table (R5, R6)
* ``start_insert_only`` foreachBatch insert-only merge (R7; consumption is the drain, R8)
* ``start_snapshot``   complete-mode aggregate rewritten as a table each batch (R10)

Every starter takes a trigger: ``{"availableNow": True}`` (default: process what is
there, then stop - used by tests and scheduled runs) or
``{"processingTime": "30 seconds"}`` for an always-on query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timekeys import parse_ts, ts_lit
from ..operators.keys import dedup_by_key
from ..operators.merge import insert_first, upsert_latest
from ..schemas import MESSAGE, MESSAGE_ORDER, STREAM_ORDER
from ..sources.tables import (insert_first_keys, merge_partitions, read_table_or_none,
                              write_version)

AVAILABLE_NOW = {"availableNow": True}


def parse_orders(raw: DataFrame, payload_col: str = "body", as_of=None) -> DataFrame:
    """Decode the message body (binary -> text -> JSON struct -> columns).

    A malformed body gives an all-NULL row and a bad field gives a NULL field; the
    cleaning step filters such rows, and ``rejected_messages`` keeps their bodies. The
    queue's time, partition and offset ride along (NULL where the source has none): they
    say which message of an order id came first.
    """
    data = F.from_json(F.col(payload_col).cast("string"), STREAM_ORDER)
    return (raw.select(data.alias("data"), *_message(raw))
            .select("data.*", *MESSAGE_ORDER).withColumn("ingested_at", ts_lit(as_of)))


def _message(raw: DataFrame) -> list[Column]:
    return [(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in MESSAGE.fields]


def rejected_messages(raw: DataFrame, payload_col: str = "body", as_of=None) -> DataFrame:
    """The messages that cleaning would drop, with body and reason (a side table)."""
    body = F.col(payload_col).cast("string")
    d = F.from_json(body, STREAM_ORDER)
    reason = (F.when(d["order_id"].isNull(), "no order id")
              .when(d["amount"].isNull(), "no amount")
              .when(d["amount"] <= 0, "amount not positive")
              .when(parse_ts(d["timestamp"]).isNull(), "no order time"))
    return (raw.select(body.alias("body"), reason.alias("reason"), *_message(raw))
            .filter(F.col("reason").isNotNull()).withColumn("ingested_at", ts_lit(as_of)))


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or AVAILABLE_NOW))


def await_done(q: StreamingQuery, timeout_s: int | None = None) -> StreamingQuery:
    """Wait for an availableNow query, however long its backlog; with ``timeout_s``, stop
    and raise if it does not finish in time."""
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
    if not finished:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def start_append(df: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Append into a Parquet folder; the checkpoint makes reruns add nothing twice."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start(path)


def _foreach(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
             trigger: dict | None, mode: str = "append") -> StreamingQuery:
    w = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(fn))
    return _trigger(w, trigger).start()


def start_batches(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Run ``fn(batch, batch_id)`` on every micro-batch; it must be safe to replay."""
    return _foreach(df, fn, checkpoint, trigger)


def start_upsert(df: DataFrame, table_root: str, keys: Sequence[str], checkpoint: str,
                 trigger: dict | None = None, partition_col: str | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 order_by: Sequence[str] = (), keep: int = 3) -> StreamingQuery:
    """Each micro-batch: ``transform``, then upsert; the latest row of a key stays.

    Latest is by ``order_by``, ties to the largest row - among stored and new rows alike
    (``upsert_latest``), so the result does not depend on how the stream is cut into
    batches, nor on late or replayed rows.

    Joins belong in ``transform``: it runs on the micro-batch as an ordinary batch
    DataFrame, so adaptive execution applies to them (runtime broadcast, skew-join
    splitting) - joins declared in the streaming plan itself run without it.

    With ``partition_col`` the table is partitioned and only the partitions the batch
    touches are read and rewritten (``merge_partitions``, which replaces them one by one);
    without it the whole (small) table is written as a new version, of which the newest
    ``keep`` stay. A batch that fails midway is replayed from the checkpoint; the upsert
    is idempotent, so the replay gives the same table.
    """
    keys = list(keys)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if transform is not None:
            batch = transform(batch)
        rows = dedup_by_key(batch, keys, order_by=order_by, keep="last")

        def latest(target, source, keys):
            return upsert_latest(target, source, keys, order_by)

        if partition_col:
            merge_partitions(rows, table_root, keys, partition_col, latest)
        else:
            write_version(latest(read_table_or_none(spark, table_root), rows, keys),
                          table_root, keep=keep)

    return _foreach(df, merge, checkpoint, trigger)


def start_insert_only(df: DataFrame, table_root: str, keys: Sequence[str],
                      checkpoint: str, trigger: dict | None = None,
                      seen: list[int] | None = None,
                      partition_col: str | None = None, keep: int = 3,
                      order_by: Sequence[str] = ()) -> StreamingQuery:
    """Each micro-batch: insert rows whose key the table does not have yet.

    Of all rows ever sent for a key the first by ``order_by`` stays (without it: the
    smallest), and rows that were in the table before the stream, which have no place in
    the queue (NULL), stay before all. So the result does not depend on how the stream is
    cut into batches: where a later batch brings an earlier message of a stored key
    (another partition of the queue was slower), the stored row gives way to it. Pass the
    queue's order (``schemas.MESSAGE_ORDER``) to have the first message win.

    Consumption through the checkpoint is the drain: a row is read once, and rows that
    arrive while a merge runs are picked up by the next batch instead of being lost to a
    truncate. ``seen`` (optional) collects the row count of every batch. With
    ``partition_col`` the table is partitioned and new rows are appended
    (``insert_first_keys``); only partitions of rows that give way are rewritten.
    """
    keys, order_by = list(keys), list(order_by)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if seen is not None:
            seen.append(batch.count())
        if partition_col:
            insert_first_keys(batch, table_root, keys, partition_col, order_by)
        else:
            target = read_table_or_none(spark, table_root)
            write_version(insert_first(target, batch, keys, order_by), table_root, keep=keep)

    return _foreach(df, merge, checkpoint, trigger)


def start_snapshot(agg: DataFrame, table_root: str, checkpoint: str,
                   trigger: dict | None = None, keep: int = 3) -> StreamingQuery:
    """Complete-mode aggregate: every batch writes the whole (small) result table; the
    newest ``keep`` versions stay."""
    def snap(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, table_root, keep=keep)

    return _foreach(agg, snap, checkpoint, trigger, mode="complete")
