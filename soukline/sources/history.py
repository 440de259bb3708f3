"""A stored slowly changing dimension, type 2, with its history apart from current rows.

The table is partitioned by ``_slot``: current rows lie in ``current-<n>`` (a hash of the
key), versions closed on a day in ``history-<day>``. A snapshot that changes few rows
rewrites the slots of these rows and the slot of its day; history closed on other days is
neither read nor written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import unique_or_error
from ..operators.merge import first_versions, scd2_changes
from ..session import drop_dir, run_dir, saved
from .tables import finish_pending, in_partitions, path_exists, stage_partitions

SLOT = "_slot"


def _slot(key: str, slots: int) -> Column:
    current = F.concat(F.lit("current-"), F.pmod(F.xxhash64(key), F.lit(slots)).cast("string"))
    closed = F.concat(F.lit("history-"), F.col("end_date").cast("string"))
    return F.when(F.col("is_current"), current).otherwise(closed)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All versions, current and closed."""
    return spark.read.parquet(root).drop(SLOT)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current versions: the slots of history are not read."""
    return spark.read.parquet(root).filter(F.col(SLOT).startswith("current-")).drop(SLOT)


def merge_history(incoming: DataFrame, root: str, key: str, as_of=None,
                  tracked: Sequence[str] = ("city",), slots: int = 64) -> int:
    """Merge a snapshot into the stored dimension (rules of ``operators.merge.scd2``).

    The snapshot meets the current rows only. Closed and added rows are computed once;
    their slots get their new contents through a stage beside the table, so a run that
    dies is completed by the next (``finish_pending``), and rerunning a snapshot changes
    nothing. ``slots`` must stay the same for a table. Returns 1 if it wrote.
    """
    spark, work = incoming.sparkSession, run_dir(incoming.sparkSession, "history")
    try:
        finish_pending(spark, root, [key], SLOT)
        if not path_exists(spark, root):
            first = first_versions(unique_or_error(incoming, [key]), as_of)
            (first.withColumn(SLOT, _slot(key, slots)).hint("rebalance", SLOT)
             .write.partitionBy(SLOT).parquet(root))
            return 1
        table = spark.read.parquet(root)
        current = table.filter(F.col(SLOT).startswith("current-"))
        changes = saved(scd2_changes(current.drop(SLOT), incoming, key, as_of, tracked)
                        .withColumn(SLOT, _slot(key, slots)), f"{work}/changes")
        if changes.isEmpty():
            return 0
        closed = changes.filter(~F.col("is_current"))
        # a closed row leaves its current slot and comes to the slot of its day
        left = closed.withColumn("is_current", F.lit(True)).select(_slot(key, slots).alias(SLOT))
        touched = saved(changes.select(SLOT).unionByName(left).distinct(), f"{work}/touched")
        kept = in_partitions(table, SLOT, touched)
        gone = closed.select(F.col(key).alias("_key"), F.lit(True).alias("_current"))
        stays = kept.join(gone, (kept[key] == gone["_key"])
                          & (kept["is_current"] == gone["_current"]), "left_anti")
        stage_partitions(stays.unionByName(changes), touched, root)
        finish_pending(spark, root, [key], SLOT)
        return 1
    finally:
        drop_dir(spark, work)
