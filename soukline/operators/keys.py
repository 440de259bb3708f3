"""Key helpers: deterministic de-duplication, sequential surrogate ids, uniqueness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import run_dir, saved


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
                 keep: str = "first") -> DataFrame:
    """One row per key; the survivor is deterministic.

    The survivor is the row whose ``(order_by..., other columns...)`` tuple is smallest
    (``keep='first'``) or largest (``keep='last'``); NULL sorts lowest. It is computed as
    a grouped ``min``/``max`` of a struct, an ordinary aggregate with a map-side partial
    step: a key that has millions of copies is folded to one row inside each map task
    before the shuffle, instead of landing whole in one task as ``row_number()`` over a
    key window would.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not order_by and not rest:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def with_sequential_id(df: DataFrame, order_cols: Sequence[str], id_col: str,
                       start=1) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order_cols`` order, without one big task.

    The rows are range-partitioned on the ordering and written once with their partition
    number to the shared folder; both the sizes of the partitions and the ids come from
    those files. (Two range partitionings of one frame may sample different bounds.)
    Rows are numbered inside each range partition and shifted by the running size of the
    partitions before it; only those sizes, one row per partition, meet in one task.
    Rows with equal ``order_cols`` are numbered in an arbitrary order.
    """
    spark, order_cols = df.sparkSession, list(order_cols)
    ranged = saved(df.repartitionByRange(*order_cols)
                   .withColumn("_part", F.spark_partition_id()), run_dir(spark, "ids"))
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order_cols)))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_offset"))
    # offsets has one row per shuffle partition: a bounded broadcast
    out = local.join(F.broadcast(offsets), "_part")
    return (out.withColumn(id_col, (F.col("_offset") + F.col("_local") + F.lit(start) - 1)
                           .cast("long"))
            .drop("_part", "_local", "_offset"))


def complete_key(keys: Sequence[str]) -> Column:
    """Whether no part of a row's key is NULL (NULL keys never match)."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return whole


def key_salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for complete keys, a hash of the row for others: rows without a key, which match
    nothing, are spread over all tasks instead of meeting in the task of NULL."""
    return F.when(complete_key(keys), F.lit(0).cast("long")).otherwise(
        F.xxhash64(*[F.col(c) for c in df.columns]))


def one_per_key(n: Column, keys: Sequence[str]) -> Column:
    """True; raises when the plan runs if ``n`` source rows of a key are more than one."""
    message = f"more than one source row for a key of {list(keys)}"
    return F.when(n > 1, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True)


def unique_or_error(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged, in one pass; the plan raises when a key (no part NULL) occurs twice.
    Rows with an incomplete key may repeat."""
    keys = list(keys)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_salt"))
    rows = df.withColumn("_salt", key_salt(df, keys)).withColumn("_n", n)
    return rows.filter(one_per_key(F.when(complete_key(keys), F.col("_n")), keys)).select(
        *df.columns)
