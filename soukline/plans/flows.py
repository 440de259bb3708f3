"""Scheduled batch jobs of the order lakehouse (bronze -> silver -> gold).

Each job reads tables by path, writes tables by path and returns nothing but small
counts; all work runs on executors. Small tables (dimensions, lookups) are written as
copy-on-write versions; the two order facts are Parquet tables partitioned by order
month and merged partition by partition (``merge_partitions``), so a run that brings
one day of orders rewrites one month, not the whole history.

All tables are stored, so Spark knows their size in bytes and broadcasts a join side only
below ``spark.sql.autoBroadcastJoinThreshold``; above, it plans a shuffle join (with AQE
skew splitting). Bronze orders, the weather store and the facts are partitioned by order
month: a run over some months reads and rewrites these partitions alone.

The stream jobs work on the same lake: ``merge_stream_orders`` adds the buffered orders to
bronze, ``stream_to_silver`` keeps the enriched stream fact, ``silver_to_live`` the live one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.timekeys import ts_lit, with_lineage
from ..schemas import (BRONZE_CUSTOMERS, BRONZE_ORDERS, BRONZE_PRODUCTS, BUFFER_SCHEMA, CURRENCY,
                       MESSAGE, MESSAGE_ORDER, SOURCE_BATCH, WEATHER)
from ..session import drop_dir, ensure_conf, run_dir, saved
from ..sources.files import csv_scan_checked
from ..sources.history import merge_history, read_history
from ..sources.tables import (PUSHED_VALUES, merge_partitions, path_exists, read_table,
                              read_table_or_none, write_version)

MONTH = "order_month"


@dataclass(frozen=True)
class LakePaths:
    """Table locations under one root (a shared filesystem / object store URI)."""
    root: str

    def __call__(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def with_month(df: DataFrame, col: str = "order_date") -> DataFrame:
    """Add the month partition column of an order table (from a date or timestamp)."""
    return df.withColumn(MONTH, F.date_format(col, "yyyy-MM"))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned fact table without its partition helper column."""
    return spark.read.parquet(path).drop(MONTH)


# -- 01: CSV -> bronze ------------------------------------------------------------------
def ingest_csv(spark: SparkSession, lake: LakePaths, csv_dirs: dict[str, str],
               as_of=None) -> None:
    """Declared-schema CSV scans + lineage columns -> the bronze tables.

    Customers and products become a new version. Orders go into the table by month: an
    order landed again, with a new amount, say, replaces what was stored for its id;
    orders that the files do not name (stream orders among them) stay. Lines that do not
    fit the schema go to ``bronze/<name>_rejects`` as they are.
    """
    ensure_conf(spark)
    for name, schema in CSV_SCHEMAS.items():
        rows, rejects = csv_scan_checked(spark, csv_dirs[name], schema)
        write_version(rejects.withColumn("ingested_at", ts_lit(as_of)),
                      lake("bronze", f"{name}_rejects"), keep=KEEP)
        rows = with_lineage(rows, SOURCE_BATCH, as_of)
        if name == "orders":
            merge_partitions(_landed_orders(rows), lake("bronze", "orders"), ["order_id"],
                             MONTH, op.replace_keys)
        else:
            write_version(rows, lake("bronze", name), keep=KEEP)


KEEP = 5        # newest versions of a small table that stay
CSV_SCHEMAS = {"customers": BRONZE_CUSTOMERS, "products": BRONZE_PRODUCTS,
               "orders": BRONZE_ORDERS}
CSV_KEYS = {"customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"]}


def _landed_orders(rows: DataFrame) -> DataFrame:
    """Batch orders in the layout of the bronze table: they never were in the queue."""
    return with_month(rows.withColumns({f.name: F.lit(None).cast(f.dataType)
                                        for f in MESSAGE.fields}), "order_time")


def ingest_csv_incremental(spark: SparkSession, lake: LakePaths, name: str, csv_dir: str,
                           checkpoint: str, as_of=None,
                           max_files_per_trigger: int | None = None) -> str:
    """Incremental form of the CSV load for a growing landing folder.

    A file-source stream with the declared schema and ``availableNow``: each run reads
    only the files that arrived since the last run (the checkpoint remembers the rest)
    and appends them, with lineage columns, to ``<lake>/bronze/<name>_stream``. A rerun
    after a failure replays exactly the uncommitted files. ``max_files_per_trigger``
    bounds each micro-batch (a backlog is then processed in several batches). Returns
    the table folder (read it with ``spark.read.parquet``).
    """
    from ..streaming.ingest import await_done, start_append
    reader = spark.readStream.schema(CSV_SCHEMAS[name]).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.option("mode", "PERMISSIVE").csv(csv_dir)
    path = lake("bronze", f"{name}_stream")
    await_done(start_append(with_lineage(src, SOURCE_BATCH, as_of), path, checkpoint))
    return path


def merge_landed(spark: SparkSession, lake: LakePaths, name: str, checkpoint: str,
                 max_files_per_trigger: int | None = None) -> None:
    """The rows :func:`ingest_csv_incremental` has landed since the last run -> the bronze
    table that silver reads: a row landed again replaces the stored one of its key.

    Each batch reads only its new files; orders rewrite only the months they touch."""
    from ..streaming.ingest import await_done, start_batches
    ensure_conf(spark)
    path = lake("bronze", f"{name}_stream")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    root, keys = lake("bronze", name), CSV_KEYS[name]

    def merge(batch: DataFrame, batch_id: int) -> None:
        if name == "orders":
            merge_partitions(_landed_orders(batch), root, keys, MONTH, op.replace_keys)
        else:
            stored = read_table_or_none(batch.sparkSession, root)
            write_version(op.replace_keys(stored, batch, keys), root, keep=KEEP)

    await_done(start_batches(reader.parquet(path), merge, checkpoint))


def read_weather(spark: SparkSession, lake: LakePaths) -> DataFrame | None:
    """The stored hourly weather (partitioned by order month), or None before the
    first enrichment run."""
    path = lake("bronze", "weather")
    return spark.read.parquet(path) if path_exists(spark, path) else None


# -- enrichment run ----------------------------------------------------------------------
def weather_coverage_table(spark: SparkSession, lake: LakePaths) -> DataFrame | None:
    """The mask of stored hours per (city, date), kept beside the weather store (taken from
    the store once, if a lake has none yet); None before the first enrichment run."""
    path = lake("bronze", "weather_coverage")
    if not path_exists(spark, path):
        stored = read_weather(spark, lake)
        if stored is None:
            return None
        merge_partitions(with_month(op.hours_by_pair(stored)), path, op.enrich.PAIR, MONTH,
                         op.upsert, stable_keys=True)
    return spark.read.parquet(path)


def enrich_stores(spark: SparkSession, lake: LakePaths, orders: DataFrame,
                  weather_docs: DataFrame, rate_docs: DataFrame, as_of=None,
                  months: list[str] | None = None) -> dict[str, int]:
    """Fill the stored weather and rate tables for whatever the orders still miss.

    The gap checks run every time, once: the gap is kept in a file. Weather is checked
    against the masks of the given months, not against the hours of the store. A store is
    rewritten only when its gap is not empty, its masks after it: a run that dies between
    the two fetches the same documents again. New rows carry ``fetched_at``.
    """
    wpath, rpath = lake("bronze", "weather"), lake("bronze", "currency")
    coverage, stored_r = weather_coverage_table(spark, lake), read_table_or_none(spark, rpath)
    if coverage is not None:
        coverage = _months(coverage, months)
    written = {"weather": 0, "currency": 0}
    work = run_dir(spark, "gaps")
    try:
        pairs = saved(op.gap_pairs(op.missing_hours(orders, coverage)), f"{work}/weather")
        if not pairs.isEmpty():
            # the weather store is partitioned by month: only the gap months are written
            filled = with_month(op.fill_weather(pairs, weather_docs)).withColumn(
                "fetched_at", ts_lit(as_of))
            merge_partitions(filled, wpath, op.enrich.WEATHER_KEYS, MONTH, op.upsert,
                             stable_keys=True)
            masks = with_month(pairs.withColumn("hours", F.lit(op.enrich.ALL_HOURS)))
            merge_partitions(masks, lake("bronze", "weather_coverage"), op.enrich.PAIR, MONTH,
                             op.upsert, stable_keys=True)
            written["weather"] = 1
        dates = saved(op.rate_gaps(orders, stored_r), f"{work}/rates")
        if not dates.isEmpty():
            filled = op.fill_rates(dates, rate_docs).withColumn("fetched_at", ts_lit(as_of))
            write_version(op.upsert(stored_r, filled, op.enrich.RATE_KEYS), rpath, keep=KEEP)
            written["currency"] = 1
        return written
    finally:
        drop_dir(spark, work)


# -- 04: bronze -> silver -----------------------------------------------------------------
def _months(df: DataFrame, months: list[str] | None, col: str = MONTH) -> DataFrame:
    """Restrict to the given order months (``None``: everything)."""
    return df if months is None else df.filter(F.col(col).isin(list(months)))


def months_of(orders: DataFrame, col: str = "order_date") -> list[str] | None:
    """The order months of a batch, for filters that prune; None (everything) if there are
    more than a list of literals should hold."""
    months = with_month(orders.select(col), col).select(MONTH).dropna().distinct()
    found = [r[0] for r in months.limit(PUSHED_VALUES + 1).toLocalIterator()]
    return found if len(found) <= PUSHED_VALUES else None


def bronze_to_silver(spark: SparkSession, lake: LakePaths, weather_docs: DataFrame,
                     rate_docs: DataFrame, months: list[str] | None = None,
                     as_of=None) -> None:
    """Silver dimensions and the enriched order fact.

    ``months`` (e.g. ``["2024-01"]``) makes the run incremental: only orders of those
    months are cleaned, enriched and merged, so only those fact partitions are
    rewritten. ``None`` reprocesses every order (the first run, or a backfill).
    """
    ensure_conf(spark)
    orders = _months(spark.read.parquet(lake("bronze", "orders")), months)
    orders = orders.drop("ingested_at", *MESSAGE_ORDER, MONTH)
    enrich_stores(spark, lake, orders, weather_docs, rate_docs, as_of, months)

    for name, cleaner, key in (("customers", op.clean_customers, "customer_id"),
                               ("products", op.clean_products, "product_id")):
        fresh = cleaner(read_table(spark, lake("bronze", name)))
        path = lake("silver", f"dim_{name}")
        write_version(op.upsert(read_table_or_none(spark, path), fresh, [key]), path, keep=KEEP)

    # only the months being processed are read (partition pruning on the store)
    weather = _months(read_weather(spark, lake), months).select(*WEATHER.fieldNames())
    currency = read_table(spark, lake("bronze", "currency")).select(*CURRENCY.fieldNames())
    fact = op.enrich_orders(op.clean_orders(orders), weather, currency)
    merge_partitions(with_month(fact), lake("silver", "fact_orders"), ["order_id"], MONTH,
                     op.upsert)


# -- 05: silver -> gold ---------------------------------------------------------------------
def silver_to_gold(spark: SparkSession, lake: LakePaths, as_of=None,
                   months: list[str] | None = None) -> None:
    """Gold dimensions and fact; ``months`` limits the fact work to those partitions
    (the filter on the partition column prunes the silver read)."""
    ensure_conf(spark)
    fact = _months(spark.read.parquet(lake("silver", "fact_orders")), months).drop(MONTH)

    dpath = lake("gold", "dim_date")
    write_version(op.upsert(read_table_or_none(spark, dpath), op.dim_date(fact), ["date_id"]),
                  dpath, keep=KEEP)
    lpath = lake("gold", "dim_location")
    write_version(op.dim_location(fact, existing=read_table_or_none(spark, lpath)), lpath,
                  keep=KEEP)

    ppath = lake("gold", "dim_products")
    products = op.dim_products(read_table(spark, lake("silver", "dim_products")), as_of=as_of)
    write_version(op.upsert(read_table_or_none(spark, ppath), products, ["product_id"]), ppath,
                  keep=KEEP)

    cpath = lake("gold", "dim_customers")
    customers = read_table(spark, lake("silver", "dim_customers"))
    as_of_date = None if as_of is None else str(as_of)[:10]
    merge_history(customers, cpath, "customer_id", as_of_date)

    dates, locs = read_table(spark, dpath), read_table(spark, lpath)
    gold = op.fact_orders_gold(fact, dates, locs)
    merge_partitions(with_month(gold), lake("gold", "fact_orders"), ["order_id"], MONTH,
                     op.upsert)


# -- stream orders on the same lake ---------------------------------------------------------
def buffer_stream(spark: SparkSession, lake: LakePaths,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """The buffer table of parsed stream orders as a stream (bounded batches on request)."""
    r = spark.readStream.schema(BUFFER_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(lake("bronze", "streaming_orders"))


def land_messages(spark: SparkSession, lake: LakePaths, messages: DataFrame,
                  as_of=None) -> None:
    """Order messages (``body``) -> the buffer table, those cleaning drops -> a side table."""
    from ..streaming.ingest import await_done, parse_orders, rejected_messages, start_append
    for name, df in (("streaming_orders", parse_orders(messages, as_of=as_of)),
                     ("streaming_rejects", rejected_messages(messages, as_of=as_of))):
        await_done(start_append(df, lake("bronze", name), lake("_checkpoints", name)))


def merge_stream_orders(spark: SparkSession, lake: LakePaths,
                        max_files_per_trigger: int | None = None) -> None:
    """Buffered stream orders with a new id -> bronze orders; the checkpoint is the drain.
    Of several messages for an id the first in the queue counts, however they arrive."""
    from ..streaming.ingest import await_done, start_insert_only
    ensure_conf(spark)
    rows = op.align_stream_orders(buffer_stream(spark, lake, max_files_per_trigger),
                                  keep=("ingested_at", *MESSAGE_ORDER))
    await_done(start_insert_only(with_month(rows, "order_time"), lake("bronze", "orders"),
                                 ["order_id"], lake("_checkpoints", "merge_orders"),
                                 partition_col=MONTH, order_by=MESSAGE_ORDER))


def stream_to_silver(spark: SparkSession, lake: LakePaths, weather_docs: DataFrame,
                     rate_docs: DataFrame, as_of=None,
                     max_files_per_trigger: int | None = None) -> None:
    """Buffered stream orders -> the enriched stream fact; each batch first fills what the
    weather and rate stores miss for its orders, and reads only the months it needs."""
    from ..streaming.ingest import await_done, start_upsert
    ensure_conf(spark)

    def enrich(batch: DataFrame) -> DataFrame:
        orders = op.clean_orders(op.align_stream_orders(batch))
        # only the stores' partitions of the batch's months are read
        months = months_of(orders)
        enrich_stores(batch.sparkSession, lake, orders, weather_docs, rate_docs, as_of, months)
        weather = read_weather(spark, lake)
        if weather is None:             # a batch without a usable order needs none
            weather = spark.createDataFrame([], WEATHER).withColumn(MONTH, F.lit(""))
        weather = _months(weather, months).select(*WEATHER.fieldNames())
        currency = read_table(spark, lake("bronze", "currency")).select(*CURRENCY.fieldNames())
        return with_month(op.enrich_orders(orders, weather, currency))

    await_done(start_upsert(buffer_stream(spark, lake, max_files_per_trigger),
                            lake("silver", "fact_streaming_orders"), ["order_id"],
                            lake("_checkpoints", "silver_stream"), partition_col=MONTH,
                            transform=enrich, order_by=["order_time"]))


def silver_to_live(spark: SparkSession, lake: LakePaths, as_of=None,
                   months: list[str] | None = None) -> None:
    """The stored stream fact + the gold dimensions -> the live fact (of some months)."""
    ensure_conf(spark)
    fact = _months(spark.read.parquet(lake("silver", "fact_streaming_orders")), months)
    dims = {n: read_table(spark, lake("gold", n))
            for n in ("dim_products", "dim_location", "dim_date")}
    live = op.fact_live(fact.drop(MONTH), dims["dim_products"], dims["dim_location"],
                        dims["dim_date"], as_of=as_of)
    merge_partitions(with_month(live), lake("gold", "fact_streaming_orders"), ["order_id"],
                     MONTH, op.upsert)


def gold_tables(spark: SparkSession, lake: LakePaths) -> dict[str, DataFrame]:
    """The gold star schema as DataFrames (for reports and dashboards)."""
    out = {n: read_table(spark, lake("gold", n))
           for n in ("dim_date", "dim_location", "dim_products")}
    out["dim_customers"] = read_history(spark, lake("gold", "dim_customers"))
    out["fact_orders"] = read_fact(spark, lake("gold", "fact_orders"))
    return out

