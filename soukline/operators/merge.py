"""Keyed merges as DataFrame algebra: insert-only, upsert (SCD1) and SCD type 2.

All three return the new table contents as a DataFrame; the caller writes it to a fresh
path (``sources.tables.write_version``), never over an input the plan still reads.
NULL keys never match (SQL equality): such target rows are kept and such source rows
are inserted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timekeys import date_lit
from .keys import complete_key, dedup_by_key, key_salt, one_per_key, unique_or_error


def _same_columns(target: DataFrame, source: DataFrame) -> None:
    if set(target.columns) != set(source.columns):
        raise ValueError(f"column sets differ: {sorted(target.columns)} vs "
                         f"{sorted(source.columns)}")


def insert_only(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                dedup_source: bool = True) -> DataFrame:
    """Keep every target row; add source rows whose key is not in the target.

    With ``dedup_source`` (default) repeated source keys arrive once; without it every
    copy of a new key is inserted, as a plain not-matched-insert merge does.
    """
    keys = list(keys)
    src = dedup_by_key(source, keys) if dedup_source else source
    if target is None:
        return src
    _same_columns(target, src)
    new = src.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def insert_first(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                 order_by: Sequence[str] = ()) -> DataFrame:
    """Insert-only merge that does not depend on which rows arrive together.

    Of all rows of a key the first by ``order_by`` stays (without it: the smallest row; NULL
    comes first): a target row, unless the source has an earlier one. Feeding rows at once
    or in any parts gives the same table. Target rows of one key that tie all stay.
    """
    keys, src = list(keys), dedup_by_key(source, keys, order_by=order_by)
    if target is None:
        return src
    _same_columns(target, src)
    order = F.struct(*[F.col(c) for c in order_by or [c for c in src.columns if c not in keys]])
    per_key = Window.partitionBy(*keys)
    first = [F.min(F.when(F.col("_source") == side, order)).over(per_key) for side in (0, 1)]
    rows = (target.withColumn("_source", F.lit(0))
            .unionByName(src.withColumn("_source", F.lit(1)))
            .withColumns({"_stored": first[0], "_sent": first[1]}))
    wins = F.col("_stored").isNull() | F.coalesce(F.col("_sent") < F.col("_stored"), F.lit(False))
    return rows.filter((F.col("_source") == 1) == wins).select(*target.columns)


def _keyed_union(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides with ``_source`` (1 or 0) and ``_sources``, the number of source
    rows of their key: both sides are planned once, moved once by key and sorted once."""
    rows = (target.withColumn("_source", F.lit(0))
            .unionByName(source.withColumn("_source", F.lit(1))))
    rows = rows.withColumn("_salt", key_salt(target, keys))
    per_key = Window.partitionBy(*keys, "_salt")
    return rows.withColumn("_sources", F.when(complete_key(keys),
                                              F.sum("_source").over(per_key)).otherwise(0))


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched target rows are replaced by the source row; the rest is inserted.

    One pass: target and source rows meet in one shuffle by key, which also counts the
    source rows of a key; two for one key are an error, raised when the plan runs.
    """
    keys = list(keys)
    if target is None:
        return unique_or_error(source, keys)
    _same_columns(target, source)
    rows = _keyed_union(target, source, keys)
    stays = (F.col("_source") == 1) | (F.col("_sources") == 0)
    return rows.filter(stays & one_per_key(F.col("_sources"), keys)).select(*target.columns)


def replace_keys(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source has go; all source rows come, copies too.

    For landing tables: a delivery replaces what an earlier one said about its keys, and
    cleaning decides about copies within one delivery."""
    if target is None:
        return source
    _same_columns(target, source)
    rows = _keyed_union(target, source, list(keys))
    return rows.filter((F.col("_source") == 1) | (F.col("_sources") == 0)).select(
        *target.columns)


def upsert_latest(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Of all rows of a key, stored or incoming, the latest by ``order_by`` stays.

    Ties go to the largest row. The rule doesn't depend on which rows arrive together,
    so any cutting of a stream into batches, and any replay, gives the same table.
    """
    rows = source if target is None else target.unionByName(source)
    return dedup_by_key(rows, keys, order_by=order_by, keep="last")


def scd2(existing: DataFrame | None, incoming: DataFrame, key: str = "customer_id",
         as_of=None, tracked: Sequence[str] = ("city",)) -> DataFrame:
    """Slowly changing dimension, type 2, in one full outer join of the current rows.

    * a current row whose tracked attribute differs from the incoming row
      (``current.city != incoming.city``, three-valued: NULL on either side is not a
      change) is closed: ``is_current = false, end_date = as_of``;
    * an incoming row with no current row left for its key is added with
      ``start_date = as_of, end_date = NULL, is_current = true``;
    * other attribute changes neither version nor update; keys missing from the
      incoming snapshot stay current; rerunning with the same snapshot is a no-op.

    History rows pass through untouched. Two incoming rows for one key are an error,
    raised when the plan runs.
    """
    if existing is None:
        return first_versions(unique_or_error(incoming, [key]), as_of)
    is_cur = F.coalesce(F.col("is_current"), F.lit(False))
    history = existing.filter(~is_cur).select(*incoming.columns, *VERSION_COLUMNS)
    return history.unionByName(scd2_versions(existing.filter(is_cur), incoming, key, as_of,
                                             tracked))


VERSION_COLUMNS = ["start_date", "end_date", "is_current"]


def first_versions(incoming: DataFrame, as_of=None) -> DataFrame:
    """Every row as a current version that starts on ``as_of``."""
    return incoming.select(*incoming.columns, date_lit(as_of).alias("start_date"),
                           F.lit(None).cast("date").alias("end_date"),
                           F.lit(True).alias("is_current"))


def scd2_versions(current: DataFrame, incoming: DataFrame, key: str = "customer_id",
                  as_of=None, tracked: Sequence[str] = ("city",)) -> DataFrame:
    """What becomes of the current rows, given a snapshot: those that stay, those closed on
    ``as_of`` and the new versions (see :func:`scd2`). History is not needed for it.

    Both sides are planned once and shuffled once by key; the same shuffle counts the
    incoming rows of a key.
    """
    return _scd2_rows(current, incoming, key, as_of, tracked).drop("_new")


def scd2_changes(current: DataFrame, incoming: DataFrame, key: str = "customer_id",
                 as_of=None, tracked: Sequence[str] = ("city",)) -> DataFrame:
    """Only the rows of :func:`scd2_versions` that are not in ``current`` as they are: those
    closed (``is_current`` false) and those added."""
    rows = _scd2_rows(current, incoming, key, as_of, tracked)
    return rows.filter(F.col("_new") | ~F.col("is_current")).drop("_new")


def _scd2_rows(current: DataFrame, incoming: DataFrame, key: str, as_of,
               tracked: Sequence[str]) -> DataFrame:
    d = date_lit(as_of)
    attrs, types = list(incoming.columns), dict(current.dtypes)
    n = F.count(F.lit(1)).over(Window.partitionBy(key, "_salt"))
    inc = (incoming.withColumn("_salt", key_salt(incoming, [key])).withColumn("_n", n)
           .filter(one_per_key(F.when(complete_key([key]), F.col("_n")), [key])).alias("n"))
    cur = (current.withColumn("_salt", key_salt(current, [key])).withColumn("_e", F.lit(True))
           .alias("e"))
    j = cur.join(inc, (F.col(f"e.{key}") == F.col(f"n.{key}"))
                 & (F.col("e._salt") == F.col("n._salt")), "full_outer")

    e_here, n_here = F.col("e._e").isNotNull(), F.col("n._n").isNotNull()
    changed = F.lit(False)
    for t in tracked:
        changed = changed | F.coalesce(F.col(f"e.{t}") != F.col(f"n.{t}"), F.lit(False))
    changed = e_here & n_here & changed
    old_row = F.struct(*[F.col(f"e.{c}").alias(c) for c in attrs],
                       F.col("e.start_date").alias("start_date"),
                       F.when(changed, d).otherwise(F.col("e.end_date")).alias("end_date"),
                       F.when(changed, F.lit(False)).otherwise(F.col("e.is_current"))
                       .alias("is_current"), F.lit(False).alias("_new"))
    new_row = F.struct(*[F.col(f"n.{c}").cast(types[c]).alias(c) for c in attrs],
                       d.alias("start_date"), F.lit(None).cast("date").alias("end_date"),
                       F.lit(True).alias("is_current"), F.lit(True).alias("_new"))
    rows = F.array(F.when(e_here, old_row), F.when(n_here & (~e_here | changed), new_row))
    return j.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))
