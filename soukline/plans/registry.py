"""The registered queries: ``(spark, sf_dir) -> DataFrame`` for every operator.

Each query builds its inputs from the fixture tables of ``sf_dir`` (so its work grows
with them) and runs the library operators on them. Clock-dependent columns are pinned
with ``AS_OF`` so results are reproducible. Queries that write (CSV round trip,
streaming) use a fresh folder under the session's shared checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.masking import mask_all_pii
from ..functions.timekeys import to_usd, with_lineage
from ..schemas import BRONZE_ORDERS, SOURCE_BATCH, TOTAL
from ..session import ensure_conf, run_dir, saved
from ..sources.files import csv_scan, csv_scan_checked, write_csv
from ..sources.history import merge_history, read_history
from ..sources.tables import merge_partitions, read_table, truncate, write_version
from . import reports as rp
from .fixtures import LandedFixtures
from .oracle import AS_OF_DATE, AS_OF_TS, KPI_DAY, SCD2_START


class Lake:
    """Bronze/silver/gold DataFrames over one fixture directory.

    Bronze, the lookup stores and the dimensions are what they are in a lake, stored
    tables: the first query of a session that needs one lands it in the shared folder,
    and Spark knows its size when it plans a join. Silver and gold facts are lazy plans over
    them that every query builds, and runs, by itself.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ensure_conf(spark)
        self.fx = LandedFixtures(spark, sf_dir)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        return cls(spark, sf_dir)

    @cached_property
    def root(self) -> str:
        """A folder for what this query writes."""
        return run_dir(self.spark, "query")

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        return saved(df, f"{self.root}/{name}")

    def landed(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.fx.land(name, build)

    def land_all(self) -> None:
        """Land every table that queries share (the bench reports the time this takes)."""
        for name in ("orders", "stream_orders", "customers", "products", "weather",
                     "currency", "weather_docs", "rate_docs"):
            getattr(self.fx, name)
        for name in ("coverage", "dim_date", "dim_location", "dim_products"):
            getattr(self, name)
        self.layers()

    @property
    def weather(self) -> DataFrame:
        return self.fx.weather

    @property
    def currency(self) -> DataFrame:
        return self.fx.currency

    @property
    def weather_docs(self) -> DataFrame:
        return self.fx.weather_docs

    @cached_property
    def coverage(self) -> DataFrame:
        return self.landed("coverage", lambda: op.hours_by_pair(self.weather))

    def layers(self) -> dict[str, DataFrame]:
        """Every table of the three layers, stored."""
        fx = self.fx
        return {"bronze.orders": fx.orders, "bronze.customers": fx.customers,
                "bronze.products": fx.products, "bronze.streaming_orders": fx.stream_orders,
                "silver.dim_customers": self.landed("silver/customers", lambda: self.customers),
                "silver.dim_products": self.landed("silver/products", lambda: self.products),
                "silver.fact_orders": self.landed("silver/fact", lambda: self.fact),
                "silver.fact_streaming_orders": self.landed("silver/stream_fact",
                                                            lambda: self.stream_fact),
                "gold.dim_date": self.dim_date, "gold.dim_location": self.dim_location,
                "gold.fact_orders": self.landed("gold/fact", lambda: self.gold_fact)}

    # silver --------------------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return op.clean_customers(self.fx.customers)

    @cached_property
    def products(self) -> DataFrame:
        return op.clean_products(self.fx.products)

    @cached_property
    def orders(self) -> DataFrame:
        return op.clean_orders(self.fx.orders)

    @cached_property
    def stream_aligned(self) -> DataFrame:
        return op.align_stream_orders(self.fx.stream_orders)

    @cached_property
    def stream_orders(self) -> DataFrame:
        return op.clean_orders(self.stream_aligned)

    @cached_property
    def fact(self) -> DataFrame:
        return op.enrich_orders(self.orders, self.weather, self.currency)

    @cached_property
    def stream_fact(self) -> DataFrame:
        return op.enrich_orders(self.stream_orders, self.weather, self.currency)

    # gold ----------------------------------------------------------------------------
    # The dimensions only need dates and cities, which the cleaned orders carry 1:1
    # (the enrichment joins are left joins on unique keys), so they are derived from
    # the cleaned orders and the plan does not repeat the enrichment joins.
    @cached_property
    def dim_date(self) -> DataFrame:
        return self.landed("dim_date", lambda: op.dim_date(self.orders))

    @cached_property
    def dim_location(self) -> DataFrame:
        return self.landed("dim_location", lambda: op.dim_location(self.orders))

    @cached_property
    def dim_products(self) -> DataFrame:
        return self.landed("dim_products", lambda: op.dim_products(self.products, as_of=AS_OF_TS))

    @cached_property
    def gold_fact(self) -> DataFrame:
        return op.fact_orders_gold(self.fact, self.dim_date, self.dim_location)

    @cached_property
    def live(self) -> DataFrame:
        return op.fact_live(self.stream_fact, self.dim_products, self.dim_location,
                            self.dim_date, as_of=AS_OF_TS)

    # merges --------------------------------------------------------------------------
    @cached_property
    def merged_orders(self) -> DataFrame:
        return op.insert_only(self.fx.orders, self.stream_aligned, ["order_id"])

    @cached_property
    def upserted_products(self) -> DataFrame:
        return op.upsert(self.products, op.clean_products(self.fx.products_changes),
                         ["product_id"])

    @cached_property
    def scd2(self) -> DataFrame:
        existing = op.scd2(None, self.customers, as_of=SCD2_START)
        return op.scd2(existing, op.clean_customers(self.fx.customers_next),
                       as_of=AS_OF_DATE)

    @cached_property
    def stored_weather(self) -> DataFrame:
        return self.weather.select(*op.enrich.WEATHER_COLUMNS)


# -- query bodies ------------------------------------------------------------------
def q_csv_roundtrip_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = Lake.of(spark, sf_dir)
    path = write_csv(lake.fx.orders, run_dir(spark, "csv") + "/orders")
    return csv_scan(spark, path, infer=True)


def q_bronze_orders_lineage(spark, sf_dir):
    return with_lineage(Lake.of(spark, sf_dir).fx.orders.drop("source"), SOURCE_BATCH,
                        as_of=AS_OF_TS)


def q_mask_pii_edge_cases(spark, sf_dir):
    """Masks over every customer row and four variants derived from it: no '@',
    '@' first, one character before '@', empty / NULL; 5- and 12-digit phones."""
    c = Lake.of(spark, sf_dir).fx.customers
    e, p = F.col("email"), F.col("phone")

    def variant(name, email, phone):
        return F.struct(F.lit(name).alias("variant"), email.alias("email"),
                        phone.alias("phone"))

    from_at = F.expr("substring(email, locate('@', email))")
    variants = F.array(
        variant("as_is", e, p),
        variant("no_at", F.replace(e, F.lit("@"), F.lit("")), F.substring(p, 1, 5)),
        variant("at_first", from_at, F.concat(p, F.lit("12"))),
        variant("one_char", F.concat(F.substring(e, 1, 1), from_at), F.lit("")),
        variant("empty", F.lit(""), F.lit(None).cast("string")))
    rows = c.select("customer_id", F.inline(variants))
    return mask_all_pii(rows)


def q_dedup_latest_lineitem(spark, sf_dir):
    li = Lake.of(spark, sf_dir).fx.table("lineitem")
    return op.dedup_by_key(li, ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"],
                           keep="last")


def q_orders_weather_join(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    return op.join_weather(lake.orders, lake.weather).select(
        "order_id", "customer_id", "product_id", "amount", "currency", "city", "order_time",
        "order_date", "order_hour", "source", "temperature", "weather_condition",
        "wind_speed", "humidity")


def q_orders_currency_join(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    return (op.join_rate(lake.orders, lake.currency)
            .withColumns({"amount_inr": F.col("amount"),
                          "amount_usd": to_usd("amount", "usd_exchange_rate")})
            .select("order_id", "customer_id", "product_id", "amount_inr", "amount_usd",
                    "currency", "city", "order_time", "order_date", "order_hour", "source",
                    "usd_exchange_rate"))


def q_upsert_composite_key(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    w = lake.stored_weather
    refresh = (w.filter(F.col("order_hour") % 6 == 0)
               .withColumn("temperature", F.col("temperature") + 0.5))
    pairs = op.gap_pairs(op.missing_hours(lake.fx.orders, lake.coverage))
    fill = op.fill_weather(pairs, lake.weather_docs).select(*op.enrich.WEATHER_COLUMNS)
    return op.upsert(w, refresh.unionByName(fill), op.enrich.WEATHER_KEYS)


def q_upsert_idempotent(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    changes = op.clean_products(lake.fx.products_changes)
    return op.upsert(lake.upserted_products, changes, ["product_id"])


def q_weather_filled(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    pairs = (lake.fx.orders.select("city", F.to_date("order_time").alias("order_date"))
             .distinct())
    return op.fill_weather(pairs, lake.weather_docs)


def q_rate_filled(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    dates = lake.fx.orders.select(F.to_date("order_time").alias("rate_date")).distinct()
    return op.fill_rates(dates, lake.fx.rate_docs).select(
        "base_currency", "target_currency", "rate_date", "exchange_rate", "is_fallback")


def q_landed_weather_documents(spark, sf_dir):
    """S6 over files: documents landed as JSON Lines, scanned, flattened to hours."""
    from pyspark.sql import types as T
    from ..sources.files import document_scan, land_documents
    lake = Lake.of(spark, sf_dir)
    path = land_documents(lake.fx.weather_docs, run_dir(spark, "docs") + "/weather")
    keys = T.StructType([T.StructField("city", T.StringType()),
                         T.StructField("order_date", T.DateType())])
    return op.flatten_hourly(document_scan(spark, path, keys))


def q_enrich_run(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    stored = (lake.stored_weather.filter(F.dayofmonth("order_date") % 3 != 0)
              .withColumn("is_fallback", F.lit(False)))
    return op.enrich_weather(lake.fx.orders, stored, lake.weather_docs)


def q_layer_summary(spark, sf_dir):
    """Row counts of the stored layers, and of customers whose PII is not masked."""
    tables = Lake.of(spark, sf_dir).layers()
    customers = tables["silver.dim_customers"]
    return rp.layer_summary({**tables,
                             "silver.dim_customers.unmasked_pii": rp.unmasked_pii(customers)})


def q_layer_samples(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    return rp.layer_samples({"silver.dim_customers": (lake.customers, "customer_id", "name"),
                             "silver.dim_products": (lake.products, "product_id", "product_name"),
                             "silver.fact_orders": (lake.fact, "order_id", "city")})


def q_merge_audit(spark, sf_dir):
    lake = Lake.of(spark, sf_dir)
    after = lake.stored(lake.merged_orders, "merged")
    return rp.merge_audit(lake.fx.orders, lake.stream_aligned, after)


def q_number_lineitems(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    rows = Lake.of(spark, sf_dir).fx.table("lineitem").select(*cols)
    return op.with_sequential_id(rows, cols, "line_id")


def q_dedup_incomplete_customers(spark, sf_dir):
    """Copies with missing fields beside full ones: the fullest copy of an id stays."""
    c, none = Lake.of(spark, sf_dir).fx.customers, F.lit(None)
    some = c.filter("customer_id % 2 = 0").withColumns(
        {x: none.cast("string") for x in ("name", "city")})
    more = c.filter("customer_id % 3 = 0").withColumns(
        {"phone": none.cast("string"), "signup_date": none.cast("date")})
    return op.clean_customers(c.unionByName(some).unionByName(more))


def q_merge_into_existing(spark, sf_dir):
    """A first load, a batch that moves rows to other months and to none, an empty batch."""
    lake = Lake.of(spark, sf_dir)
    root, month = f"{lake.root}/merged", "order_month"
    rows = lake.fx.orders.select("order_id", "amount", F.date_format(
        "order_time", "yyyy-MM").alias(month), "order_time")
    later = F.date_format(F.expr("order_time + INTERVAL '31' DAY"), "yyyy-MM")
    moved = rows.filter("order_id % 3 = 0").withColumns({
        "amount": (F.col("amount") + 1).cast(rows.schema["amount"].dataType),
        month: F.when(F.col("order_id") % 5 != 0, later)})
    new = rows.filter("order_id % 7 = 0").withColumns({
        "order_id": -F.col("order_id") - 1,
        month: F.when(F.col("order_id") % 2 == 0, F.lit("1900-01"))})
    merge = lambda df: merge_partitions(
        df.select("order_id", "amount", month), root, ["order_id"], month, op.upsert)
    merge(rows.filter("false"))
    merge(rows)
    merge(moved.unionByName(new))
    merge(rows.filter("false"))
    return spark.read.schema(f"order_id long, amount decimal(18,2), {month} string").parquet(root)


def q_csv_rejects(spark, sf_dir):
    """Order lines with an amount that is no number, a field too many or too few: they come
    back as text, and the rows that fit are counted beside them."""
    orders = Lake.of(spark, sf_dir).fx.orders
    k = F.col("order_id")
    fields = [F.when(k % 50 == 0, F.lit("none")).otherwise(F.col("amount").cast("string"))
              if c == "amount" else F.col(c).cast("string") for c in BRONZE_ORDERS.fieldNames()]
    line = F.concat_ws(",", *fields)
    line = (F.when(k % 50 == 1, F.concat(line, F.lit(",more")))
            .when(k % 50 == 2, F.concat_ws(",", *fields[:4])).otherwise(line))
    path = run_dir(spark, "rejects") + "/orders"
    orders.select(line.alias("value")).write.text(path)
    rows, rejects = csv_scan_checked(spark, path, BRONZE_ORDERS, header=False)
    fit = rows.agg(F.lit("rows that fit").alias("line"), F.count(F.lit(1)).alias("n"),
                   F.sum("amount").cast(TOTAL).alias("amount"))
    return rejects.select("line", F.lit(1).cast("long").alias("n"),
                          F.lit(None).cast(TOTAL).alias("amount")).unionByName(fit)


def q_scd2_stored_history(spark, sf_dir):
    """Two customer snapshots into the stored dimension, the second one twice."""
    lake = Lake.of(spark, sf_dir)
    root, key = f"{lake.root}/customers", "customer_id"
    merge_history(lake.customers, root, key, SCD2_START)
    for _ in range(2):
        merge_history(op.clean_customers(lake.fx.customers_next), root, key, AS_OF_DATE)
    return read_history(spark, root)


def q_orders_landed_again(spark, sf_dir):
    """A delivery of order files, stream orders beside it, then corrections of every third."""
    from . import flows
    from ..streaming.source import order_messages
    lake = Lake.of(spark, sf_dir)
    paths, fx = flows.LakePaths(f"{lake.root}/lake"), lake.fx
    first = fx.orders.drop("source")
    again = first.filter("order_id % 3 = 0").withColumns({
        "amount": (F.col("amount") + 1).cast(first.schema["amount"].dataType),
        "order_time": F.expr("order_time + INTERVAL '40' DAY")})
    for name, orders in (("first", first), ("again", again)):
        dirs = {n: write_csv(df, f"{lake.root}/{name}/{n}") for n, df in (
            ("customers", fx.customers), ("products", fx.products), ("orders", orders))}
        flows.ingest_csv(spark, paths, dirs, as_of=AS_OF_TS)
        if name == "first":
            flows.land_messages(spark, paths, order_messages(fx), AS_OF_TS)
            flows.merge_stream_orders(spark, paths)
    return spark.read.parquet(paths("bronze", "orders")).select(
        "order_id", "amount", "order_time", "source", "message_partition", flows.MONTH)


def q_truncate_keeps_schema(spark, sf_dir):
    """A stored table before and after it is emptied, and after the next load into it."""
    lake = Lake.of(spark, sf_dir)
    root, out = f"{lake.root}/orders", None
    steps = (("loaded", lambda: write_version(lake.fx.orders, root)),
             ("emptied", lambda: truncate(spark, root)),
             ("loaded again", lambda: write_version(read_table(spark, root).unionByName(
                 lake.stream_aligned), root)))
    for step, act in steps:
        act()
        rows = read_table(spark, root)
        part = rows.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"),
                        F.sum("amount").cast(TOTAL).alias("amount"),
                        F.lit(len(rows.columns)).cast("long").alias("n_columns"))
        out = part if out is None else out.unionByName(part)
    return out


def q_lakehouse_end_to_end(spark, sf_dir):
    """CSV files -> bronze -> enrichment run -> silver -> gold -> revenue by category."""
    from . import flows
    lake = Lake.of(spark, sf_dir)
    root = run_dir(spark, "e2e")
    csv = {"customers": lake.fx.customers, "products": lake.fx.products,
           "orders": lake.fx.orders.drop("source")}
    dirs = {name: write_csv(df, f"{root}/landing/{name}") for name, df in csv.items()}
    paths = flows.LakePaths(f"{root}/lake")
    flows.ingest_csv(spark, paths, dirs, as_of=AS_OF_TS)
    flows.bronze_to_silver(spark, paths, lake.fx.weather_docs, lake.fx.rate_docs)
    flows.silver_to_gold(spark, paths, as_of=AS_OF_TS)
    gold = flows.gold_tables(spark, paths)
    return rp.revenue_by_category(gold["fact_orders"], gold["dim_products"])


def _lake(fn: Callable[[Lake], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Lake.of(spark, sf_dir))


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_roundtrip_infer": q_csv_roundtrip_infer,
    "bronze_orders_lineage": q_bronze_orders_lineage,
    "clean_customers": _lake(lambda l: l.customers),
    "clean_products": _lake(lambda l: l.products),
    "clean_orders": _lake(lambda l: l.orders),
    "mask_pii_edge_cases": q_mask_pii_edge_cases,
    "dedup_latest_lineitem": q_dedup_latest_lineitem,
    "orders_weather_join": q_orders_weather_join,
    "weather_coverage": _lake(lambda l: op.weather_coverage(l.fact)),
    "orders_currency_join": q_orders_currency_join,
    "fact_orders_silver": _lake(lambda l: l.fact),
    "dim_date": _lake(lambda l: l.dim_date),
    "dim_location": _lake(lambda l: l.dim_location),
    "dim_products_scd1": _lake(lambda l: l.dim_products),
    "fact_orders_gold": _lake(lambda l: l.gold_fact),
    "fact_live_gold": _lake(lambda l: l.live),
    "revenue_by_category": _lake(lambda l: rp.revenue_by_category(l.gold_fact, l.dim_products)),
    "orders_by_source": _lake(lambda l: rp.orders_by_source(l.merged_orders)),
    "buffer_by_date": _lake(lambda l: rp.buffer_by_date(l.fx.stream_orders)),
    "last_dates": _lake(lambda l: rp.last_dates(l.merged_orders)),
    "live_totals": _lake(lambda l: rp.live_totals(l.live)),
    "live_top_cities": _lake(lambda l: rp.live_top_cities(l.live)),
    "live_by_category": _lake(lambda l: rp.live_by_category(l.live)),
    "live_by_hour": _lake(lambda l: rp.live_by_hour(l.live)),
    "live_by_weather": _lake(lambda l: rp.live_by_weather(l.live)),
    "top_cities_by_count": _lake(lambda l: rp.top_cities_by_count(l.stream_fact)),
    "live_revenue": _lake(lambda l: rp.live_revenue(l.stream_fact)),
    "weather_distribution": _lake(lambda l: rp.weather_distribution(l.stream_fact)),
    "merge_insert_only": _lake(lambda l: l.merged_orders),
    "merge_audit": q_merge_audit,
    "merge_into_existing": q_merge_into_existing,
    "number_lineitems": q_number_lineitems,
    "dedup_incomplete_customers": q_dedup_incomplete_customers,
    "live_kpi_refresh": _lake(lambda l: rp.kpi_refresh(l.live)),
    "csv_rejects": q_csv_rejects,
    "truncate_keeps_schema": q_truncate_keeps_schema,
    "scd2_stored_history": q_scd2_stored_history,
    "orders_landed_again": q_orders_landed_again,
    "live_totals_on_day": _lake(lambda l: rp.live_totals(l.live, as_of=KPI_DAY)),
    "layer_samples": q_layer_samples,
    "upsert_products": _lake(lambda l: l.upserted_products),
    "upsert_composite_key": q_upsert_composite_key,
    "upsert_idempotent": q_upsert_idempotent,
    "scd2_customers": _lake(lambda l: l.scd2),
    "scd2_counts": _lake(lambda l: rp.scd2_counts(l.scd2)),
    "weather_gaps": _lake(lambda l: op.weather_gaps(l.fx.orders, coverage=l.coverage)),
    "weather_pairs": _lake(lambda l: op.gap_pairs(op.missing_hours(l.fx.orders, l.coverage))),
    "rate_gaps": _lake(lambda l: op.rate_gaps(l.fx.orders, l.currency)),
    "hourly_flatten": _lake(lambda l: op.flatten_hourly(l.fx.weather_docs)),
    "landed_weather_documents": q_landed_weather_documents,
    "weather_filled": q_weather_filled,
    "rate_filled": q_rate_filled,
    "geocode_first": _lake(lambda l: op.geocode_first(l.fx.geocode_docs)),
    "enrich_run": q_enrich_run,
    "layer_summary": q_layer_summary,
    "lakehouse_end_to_end": q_lakehouse_end_to_end,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from ..streaming.jobs import STREAM_QUERIES
    return {**BATCH_QUERIES, **STREAM_QUERIES}
