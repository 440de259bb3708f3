"""Tables at a path, written copy-on-write.

A table is a folder of numbered Parquet versions ``<root>/v000001``, ... . A write
always goes to a new version folder and becomes visible when Spark's ``_SUCCESS``
marker lands, so a merge can read the current version while it writes the next one,
and a failed job leaves the previous version intact (a rerun simply writes again).
Readers take the newest committed version. This is the replacement for the keyed
merge command of a table format that is not available here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import dedup_by_key
from ..operators.merge import replace_keys
from ..session import drop_dir, run_dir, saved


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(conf), path, jvm


def versions(spark: SparkSession, root: str, committed: bool = True) -> list[int]:
    """Version numbers, ascending (only committed ones unless ``committed=False``)."""
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
            if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(),
                                                                         "_SUCCESS")):
                out.append(int(name[1:]))
    return sorted(out)


def table_exists(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version (raises if the table does not exist)."""
    v = versions(spark, root)
    if not v:
        raise FileNotFoundError(f"no committed table at {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v{v[-1]:06d}")


def read_table_or_none(spark: SparkSession, root: str) -> DataFrame | None:
    return read_table(spark, root) if table_exists(spark, root) else None


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None,
                  keep: int | None = None) -> str:
    """Write ``df`` as the next version of the table at ``root``; returns its path.

    ``keep`` deletes all but the newest versions (at least 2: a reader may still be on
    the one before); without it every version stays.
    """
    spark = df.sparkSession
    v = versions(spark, root, committed=False)   # skip past folders of failed writes
    path = f"{root.rstrip('/')}/v{(v[-1] + 1 if v else 1):06d}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if keep is not None:
        for old in versions(spark, root)[:-max(2, keep)]:
            drop_dir(spark, f"{root.rstrip('/')}/v{old:06d}")
    return path


def path_exists(spark: SparkSession, root: str) -> bool:
    fs, path, _ = _fs(spark, root)
    return fs.exists(path)


# -- partitioned tables: which partitions a source touches --------------------------------
# up to this many partition values become a pushed IN list; more go through a semi join
PUSHED_VALUES = 1000


def in_partitions(table: DataFrame, partition_col: str, values: DataFrame) -> DataFrame:
    """The rows of ``table`` in the given partitions (one row of ``values`` each, NULL too).

    The values become literals, so that the scan lists and reads only those folders
    (``PartitionFilters`` in the plan). A source that touches more than ``PUSHED_VALUES``
    partitions is joined instead, which reads the table whole: it rewrites most of it."""
    found = [r[0] for r in values.limit(PUSHED_VALUES + 1).toLocalIterator()]
    if len(found) > PUSHED_VALUES:
        some = values.select(F.col(values.columns[0]).alias("_value"))
        return table.join(some, table[partition_col].eqNullSafe(some["_value"]), "left_semi")
    col = F.col(partition_col)
    some = [v for v in found if v is not None]
    wanted = col.isin(some) if some else F.lit(False)
    return table.filter(wanted | col.isNull() if None in found else wanted)


def near_keys(table: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` between the smallest and the largest source value of the first key.

    The two values are literals, so they reach the Parquet scan (``PushedFilters``): files
    are written sorted by key, and a file or row group whose key range lies outside is
    not read. Ids that grow with time make a batch's range narrow. Rows without the key
    are among them if the source has such rows."""
    key = F.col(keys[0])
    lo, hi, none = source.agg(F.min(key), F.max(key), F.bool_or(key.isNull())).first()
    near = F.lit(False) if lo is None else key.between(F.lit(lo), F.lit(hi))
    return table.filter(near | key.isNull() if none else near)


def touched_partitions(table: DataFrame, source: DataFrame, keys: list[str],
                       partition_col: str, stable_keys: bool = False) -> DataFrame:
    """Distinct partition values of the source rows and of stored rows with their keys."""
    touched = source.select(partition_col)
    if not stable_keys:
        stored = near_keys(table.select(*keys, partition_col), source, keys)
        touched = touched.unionByName(
            stored.join(source.select(*keys), keys, "left_semi").select(partition_col))
    return touched.distinct()


def _sorted_write(df: DataFrame, keys: list[str], partition_col: str):
    """A writer of files sorted by key, so that their key statistics are narrow.

    Rebalance: AQE splits a hot partition value over several tasks and files and packs
    small ones together, instead of one task per value."""
    return (df.hint("rebalance", partition_col).sortWithinPartitions(partition_col, *keys)
            .write.partitionBy(partition_col))


# -- replacing partitions so that a crash loses nothing ------------------------------------
def _pending(root: str) -> str:
    # a leading underscore hides the folder from readers of the table
    return f"{root.rstrip('/')}/_pending"


def _drop_partitions(values: DataFrame, root: str) -> None:
    """Delete the folders of the given partition values (one row per partition)."""
    spark, col = values.sparkSession, values.columns[0]
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in values.toLocalIterator():
        drop_dir(spark, f"{root.rstrip('/')}/{utils.getPartitionPathString(col, row[0])}")


def stage_partitions(merged: DataFrame, touched: DataFrame, root: str) -> None:
    """Keep the new contents of the touched partitions beside the table, complete, before
    any of its folders changes (``touched`` last: its ``_SUCCESS`` seals the stage)."""
    merged.write.parquet(f"{_pending(root)}/merged")
    touched.write.parquet(f"{_pending(root)}/touched")


def finish_pending(spark: SparkSession, root: str, keys: list[str], partition_col: str) -> bool:
    """Put a sealed stage in place of the partitions it covers; True if there was one.

    Every step can be repeated, so a merge that died anywhere is completed by the next one
    (or by calling this). A stage that was never sealed had not changed the table and is
    dropped. One writer per table at a time, as for any file table without a log."""
    stage = _pending(root)
    if not path_exists(spark, stage):
        return False
    sealed = path_exists(spark, f"{stage}/touched/_SUCCESS")
    if sealed:
        merged = spark.read.parquet(f"{stage}/merged")
        touched = spark.read.parquet(f"{stage}/touched")
        (_sorted_write(merged, keys, partition_col).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(root))
        left = merged.select(F.col(partition_col).alias("_left")).distinct()
        emptied = touched.join(left, touched[partition_col].eqNullSafe(left["_left"]),
                               "left_anti")
        _drop_partitions(emptied, root)
    drop_dir(spark, stage)
    return sealed


def _create(source: DataFrame, root: str, keys: list[str], partition_col: str) -> int:
    """The first write of a table: nothing is merged, so the source goes straight into it.
    A source without rows, or a write that fails, leaves no folder."""
    spark = source.sparkSession
    try:
        _sorted_write(source, keys, partition_col).parquet(root)
        empty = spark.read.schema(source.schema).parquet(root).isEmpty()
    except Exception:
        drop_dir(spark, root)
        raise
    if empty:
        drop_dir(spark, root)
    return 0 if empty else 1


def merge_partitions(source: DataFrame, root: str, keys: list[str], partition_col: str,
                     merge, stable_keys: bool = False) -> int:
    """Keyed merge into a partitioned table that reads and rewrites only what it must.

    ``root`` is a Parquet table partitioned by ``partition_col`` (NULL is a partition
    like any other). The partitions to rewrite are those of the source rows plus those
    that hold a source key now (found in the key and partition columns of the files whose
    key range meets the source's, see :func:`near_keys`; skipped with ``stable_keys=True``
    when a key can never change partition). Only they are read (:func:`in_partitions`) and
    merged with ``merge(target_part, source, keys)``. The source is computed
    once: kept in a file or, where there is no table yet, written straight into it. An empty
    source writes nothing; returns 1 if it wrote.

    The result is first kept whole beside the table, then put in place partition by
    partition. A reader in between sees some old and some new partitions; after a crash
    the next merge first completes the one that died (:func:`finish_pending`).
    """
    spark = source.sparkSession
    work = run_dir(spark, "merge")
    try:
        finish_pending(spark, root, keys, partition_col)
        if not path_exists(spark, root):
            return _create(source, root, keys, partition_col)
        source = saved(source, f"{work}/source")
        if source.isEmpty():
            return 0
        table = spark.read.schema(source.schema).parquet(root)
        touched = saved(touched_partitions(table, source, keys, partition_col, stable_keys),
                        f"{work}/touched")
        target = in_partitions(table, partition_col, touched)
        stage_partitions(merge(target.select(*source.columns), source, keys), touched, root)
        finish_pending(spark, root, keys, partition_col)
        return 1
    finally:
        drop_dir(spark, work)


def append_new_keys(source: DataFrame, root: str, keys: list[str],
                    partition_col: str | None = None, stable_keys: bool = False,
                    stored: bool = False) -> int:
    """Insert-only merge by appending: rows whose key the table lacks are appended.

    Existing rows are never rewritten. The existence check reads the key columns of the
    files whose key range meets the source's, in any partition; with ``stable_keys=True``
    (a key never changes partition) only in the partitions of the source rows. A replay
    after a committed append finds the keys and appends nothing, so the operation is
    idempotent. An empty source writes nothing; returns 1 if it wrote. ``stored``: the
    source is a read of files already, and is not kept once more.
    """
    spark = source.sparkSession
    work = run_dir(spark, "append")
    try:
        new = source
        if path_exists(spark, root):
            source = source if stored else saved(source, f"{work}/source")
            table = near_keys(spark.read.schema(source.schema).parquet(root), source, keys)
            if stable_keys and partition_col:
                table = in_partitions(table, partition_col,
                                      source.select(partition_col).distinct())
            # a row without key that stands there already is not sent again either
            ids = table.select(*[F.col(k).alias(f"_{k}") for k in keys])
            new = source.join(ids, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys],
                              "left_anti")
        new = saved(new, f"{work}/new")
        if new.isEmpty():
            return 0
        if partition_col:
            _sorted_write(new, keys, partition_col).mode("append").parquet(root)
        else:
            new.sortWithinPartitions(*keys).write.mode("append").parquet(root)
        return 1
    finally:
        drop_dir(spark, work)


def first_changes(source: DataFrame, root: str, keys: list[str],
                  order_by: list[str] | None = None) -> DataFrame:
    """The source rows that an insert-only merge takes in, with ``_old``, the stored row
    that gives way to them (NULL for a new key).

    Of all rows of a key, stored or sent, the first by ``order_by`` stays (without it: the
    smallest; NULL, a row that never was in the queue, comes first). Only stored rows in
    the key range of the source are read. A row without key matches a stored one without.
    """
    spark = source.sparkSession
    rows = dedup_by_key(source, keys, order_by=order_by or [])
    kind = f"struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in rows.schema)}>"
    if not path_exists(spark, root):
        return rows.withColumn("_old", F.lit(None).cast(kind))
    table = near_keys(spark.read.schema(rows.schema).parquet(root), rows, keys)
    ids = rows.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    stored = dedup_by_key(table.join(ids, on, "left_semi"), keys, order_by=order_by or [])
    old = stored.select(*[F.col(k).alias(f"_{k}") for k in keys],
                        F.struct(*rows.columns).alias("_old"))
    order = order_by or [c for c in rows.columns if c not in keys]
    earlier = (F.struct(*[F.col(c) for c in order])
               < F.struct(*[F.col(f"_old.{c}").alias(c) for c in order]))
    return (rows.join(old, on, "left").filter(F.col("_old").isNull() | earlier)
            .select(*rows.columns, "_old"))


def apply_first(changes: DataFrame, root: str, keys: list[str], partition_col: str) -> int:
    """Put the rows of :func:`first_changes` (stored ones) into the table: new keys are
    appended, unless an earlier try has; rows that give way are replaced."""
    rows = changes.drop("_old")
    new = rows.filter(changes["_old"].isNull())
    wrote = append_new_keys(new, root, keys, partition_col, stored=True)
    given_way = changes.filter(changes["_old"].isNotNull()).drop("_old")
    # mostly there are none, and then no merge begins
    if given_way.isEmpty():
        return wrote
    return wrote | merge_partitions(given_way, root, keys, partition_col, replace_keys)


def insert_first_keys(source: DataFrame, root: str, keys: list[str], partition_col: str,
                      order_by: list[str] | None = None) -> int:
    """Insert-only merge into a partitioned table, independent of which rows arrive
    together (:func:`first_changes`). Returns 1 if it wrote."""
    spark = source.sparkSession
    work = run_dir(spark, "first")
    try:
        finish_pending(spark, root, keys, partition_col)
        source = saved(source, f"{work}/source")
        if source.isEmpty():
            return 0
        changes = saved(first_changes(source, root, keys, order_by), f"{work}/changes")
        return apply_first(changes, root, keys, partition_col)
    finally:
        drop_dir(spark, work)


def truncate(spark: SparkSession, root: str) -> str:
    """Empty the table keeping its schema (``limit(0)`` folds to an empty relation)."""
    return write_version(read_table(spark, root).limit(0), root)
