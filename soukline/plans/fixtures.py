"""Retail-shaped inputs derived from the driver's TPC-H-like tables.

``Fixtures`` builds them as Spark DataFrames (lazily, each once per instance); the same
definitions as SQL text (for the DuckDB oracle) live in ``FIXTURE_SQL``. The two are
written independently so the oracle check also covers the fixture derivation. The
Spark side replaces the SQL's two small cross joins with generators (``explode``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.enrich import weather_description
from ..schemas import MONEY, RATE, SOURCE_BATCH
from ..session import run_dir
from ..sources.tables import path_exists


_SCHEMAS: dict[tuple[str, str], StructType] = {}


class Fixtures:
    """Bronze-shaped fixture DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One scan relation per table and fixture set; footers are read once a session."""
        if name not in self._tables:
            path = f"{self.sf_dir}/{name}.parquet"
            key = (self.spark.sparkContext.applicationId, path)
            if key not in _SCHEMAS:
                _SCHEMAS[key] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[key]).parquet(path)
        return self._tables[name]

    # -- bronze batch ----------------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        """fx_orders: one order per TPC-H order, city = customer's nation."""
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                        "o_orderdate")
        c = self.table("customer").select("c_custkey", "c_nationkey")
        n = self.table("nation").select("n_nationkey", "n_name")
        k = F.col("o_orderkey")
        amt = F.col("o_totalprice").cast(MONEY)
        return (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(k.cast("long").alias("order_id"),
                        F.col("o_custkey").cast("long").alias("customer_id"),
                        (k % 200).cast("long").alias("product_id"),
                        F.when(k % 97 == 0, -amt).otherwise(amt).alias("amount"),
                        F.lit("INR").alias("currency"),
                        F.col("n_name").alias("city"),
                        F.expr("CAST(concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' ', "
                               "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':15:00') "
                               "AS TIMESTAMP)").alias("order_time"),
                        F.lit(SOURCE_BATCH).alias("source")))

    @cached_property
    def stream_orders(self) -> DataFrame:
        """fx_stream_orders: one buffered stream order per purchase event."""
        return self.stream_orders_from(self.table("events"))

    def stream_orders_from(self, events: DataFrame) -> DataFrame:
        """Purchase events (batch or streaming) -> stream-order rows."""
        c = self.table("customer").select("c_custkey", "c_nationkey")
        n = self.table("nation").select("n_nationkey", "n_name")
        e = events.filter(F.col("event_type") == "purchase")
        return (e.join(c, F.col("user_id") == F.col("c_custkey"))
                .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .select((F.col("event_id") * 2).cast("long").alias("order_id"),
                        F.col("user_id").cast("long").alias("customer_id"),
                        (F.col("event_id") % 200).cast("long").alias("product_id"),
                        F.col("value").cast(MONEY).alias("amount"),
                        F.lit("INR").alias("currency"),
                        F.col("n_name").alias("city"),
                        F.substring(F.col("ts").cast("string"), 1, 19).alias("timestamp")))

    @cached_property
    def customers(self) -> DataFrame:
        """fx_customers: dirty case and blanks, some NULL emails, exact duplicates."""
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        k = F.col("c_custkey")
        copies = F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
                .withColumn("copy", F.explode(copies))
                .select(k.cast("long").alias("customer_id"),
                        F.expr("concat('  ', lower(replace(c_name, '#', ' ')), ' ')")
                        .alias("name"),
                        F.when(k % 41 == 0, F.lit(None).cast("string"))
                        .otherwise(F.concat(F.lit("user"), k.cast("string"),
                                            F.lit("@example.com"))).alias("email"),
                        (F.lit(9000000000) + k).cast("string").alias("phone"),
                        F.concat(F.lower("n_name"), F.lit(" ")).alias("city"),
                        F.col("r_name").alias("country"),
                        F.date_add(F.lit("2020-01-01").cast("date"), (k % 365).cast("int"))
                        .alias("signup_date")))

    @cached_property
    def products(self) -> DataFrame:
        """fx_products: one in 50 priced 0."""
        k = F.col("p_partkey")
        price = F.col("p_retailprice").cast(MONEY)
        return self.table("part").select(
            k.cast("long").alias("product_id"),
            F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.when(k % 50 == 0, F.lit(0).cast(MONEY)).otherwise(price).alias("price"))

    @cached_property
    def products_changes(self) -> DataFrame:
        """fx_products_changes: new prices for every third id plus new (negative) ids."""
        p = self.products
        changed = p.filter(F.col("product_id") % 3 == 0).withColumn(
            "price", F.round(F.col("price") * F.lit(1.1).cast("decimal(2,1)"), 2).cast(MONEY))
        added = p.filter(F.col("product_id") % 5 == 0).withColumn(
            "product_id", -F.col("product_id") - 1)
        return changed.unionByName(added)

    @cached_property
    def customers_next(self) -> DataFrame:
        """fx_customers_next: moved, renamed, NULL-city, missing and new customers."""
        c, k = self.customers, F.col("customer_id")
        nxt = c.filter(k % 13 != 0).withColumns({
            "name": F.when(k % 11 == 0, F.concat("name", F.lit("x"))).otherwise(F.col("name")),
            "city": F.when(k % 19 == 0, F.lit(None).cast("string"))
                     .when(k % 7 == 0, F.lit("moved")).otherwise(F.col("city"))})
        new = c.filter(k % 17 == 0).withColumn("customer_id", -k - 1)
        return nxt.unionByName(new)

    # -- enrichment stores ------------------------------------------------------------
    def _order_dates(self) -> DataFrame:
        a = self.orders.select("city", F.to_date("order_time").alias("order_date"))
        b = self.stream_orders.select(
            "city", F.to_date(F.col("timestamp").cast("timestamp")).alias("order_date"))
        return a.union(b).distinct()

    @cached_property
    def weather(self) -> DataFrame:
        """fx_weather: 24 hourly rows per (city, date) except days divisible by 7."""
        n = self.table("nation").select("n_nationkey", "n_name")
        day, h, nk = F.dayofmonth("order_date"), F.col("order_hour"), F.col("n_nationkey")
        code = ((nk * 7 + day * 3 + h) % 100).cast("int")
        return (self._order_dates().join(n, F.col("city") == F.col("n_name"))
                .filter(day % 7 != 0)
                .withColumn("order_hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
                .select("city", "order_date", "order_hour",
                        ((nk * 3 + day + h) % 40).cast("double").alias("temperature"),
                        code.alias("weather_code"),
                        weather_description(code).alias("weather_condition"),
                        ((nk + h) % 25).cast("double").alias("wind_speed"),
                        ((day * 3 + h) % 101).cast("int").alias("humidity")))

    @cached_property
    def currency(self) -> DataFrame:
        """fx_currency: INR->USD per order date except days 10, 20, 30."""
        d = self._order_dates().select("order_date").distinct()
        day = F.dayofmonth("order_date")
        return (d.filter(day % 10 != 0)
                .select(F.lit("INR").alias("base_currency"),
                        F.lit("USD").alias("target_currency"),
                        F.col("order_date").alias("rate_date"),
                        (F.lit(0.011).cast("decimal(4,3)")
                         + day * F.lit(0.0001).cast("decimal(4,4)")).cast(RATE)
                        .alias("exchange_rate")))

    # -- landed payloads (what the HTTP calls would have returned) ------------------
    @cached_property
    def weather_docs(self) -> DataFrame:
        """One JSON weather document per stored (city, date); 24-element arrays.

        The ``collect_list`` gathers one (city, date) group: at most 24 rows, whatever
        the data volume.
        """
        w = self.weather
        g = w.groupBy("city", "order_date").agg(F.sort_array(F.collect_list(F.struct(
            "order_hour", "temperature", "weather_code", "wind_speed", "humidity"))).alias("h"))
        doc = F.struct(F.struct(
            F.col("h.temperature").alias("temperature_2m"),
            F.col("h.weather_code").alias("weathercode"),
            F.col("h.wind_speed").alias("windspeed_10m"),
            F.col("h.humidity").alias("relativehumidity_2m")).alias("hourly"))
        return g.select("city", "order_date", F.to_json(doc).alias("payload"))

    @cached_property
    def rate_docs(self) -> DataFrame:
        """One JSON rate document per stored rate date."""
        return self.currency.select("rate_date", F.to_json(F.struct(F.struct(
            F.col("exchange_rate").alias("USD")).alias("rates"))).alias("payload"))

    @cached_property
    def geocode_docs(self) -> DataFrame:
        """One geocode document per nation; every fifth one has no results."""
        n = self.table("nation")
        hit = F.to_json(F.struct(F.array(F.struct(
            F.col("n_nationkey").cast("double").alias("latitude"),
            F.col("n_regionkey").cast("double").alias("longitude"))).alias("results")))
        return n.select(F.col("n_name").alias("city"),
                        F.when(F.col("n_nationkey") % 5 == 0, F.lit("{}")).otherwise(hit)
                        .alias("payload"))


class LandedFixtures(Fixtures):
    """The same tables, each written to the shared folder on first use and read from there,
    as a lake has them. Later users in the session read the files; plans over them are
    their own."""

    def land(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _LANDED or not path_exists(self.spark, _LANDED[key][0]):
            path = run_dir(self.spark, f"landed-{name.replace('/', '-')}")
            df = build()
            df.write.parquet(path)
            _LANDED[key] = (path, df.schema)
        path, schema = _LANDED[key]
        return self.spark.read.schema(schema).parquet(path)

    def _landed(name: str) -> cached_property:  # noqa: N805
        return cached_property(lambda self: self.land(
            name, lambda: getattr(Fixtures, name).func(self)))

    orders = _landed("orders")
    stream_orders = _landed("stream_orders")
    customers = _landed("customers")
    products = _landed("products")
    weather = _landed("weather")
    currency = _landed("currency")
    weather_docs = _landed("weather_docs")
    rate_docs = _landed("rate_docs")


_LANDED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


# ---------------------------------------------------------------------------------
# The same fixtures as SQL text (valid in DuckDB; the oracle side).
# ---------------------------------------------------------------------------------
FIXTURE_SQL = {
    "fx_orders": """
SELECT CAST(o.o_orderkey AS BIGINT) AS order_id, CAST(o.o_custkey AS BIGINT) AS customer_id,
  CAST(o.o_orderkey % 200 AS BIGINT) AS product_id,
  CASE WHEN o.o_orderkey % 97 = 0 THEN -CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE CAST(o.o_totalprice AS DECIMAL(18,2)) END AS amount,
  'INR' AS currency, n.n_name AS city,
  CAST(concat(CAST(CAST(o.o_orderdate AS DATE) AS STRING), ' ', lpad(CAST(o.o_orderkey % 24 AS STRING), 2, '0'), ':15:00') AS TIMESTAMP) AS order_time,
  'batch_csv' AS source
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "fx_stream_orders": """
SELECT CAST(e.event_id * 2 AS BIGINT) AS order_id, CAST(e.user_id AS BIGINT) AS customer_id,
  CAST(e.event_id % 200 AS BIGINT) AS product_id, CAST(e.value AS DECIMAL(18,2)) AS amount,
  'INR' AS currency, n.n_name AS city, substr(CAST(e.ts AS STRING), 1, 19) AS timestamp
FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE e.event_type = 'purchase'""",
    "fx_customers": """
SELECT CAST(c.c_custkey AS BIGINT) AS customer_id, concat('  ', lower(replace(c.c_name, '#', ' ')), ' ') AS name,
  CASE WHEN c.c_custkey % 41 = 0 THEN NULL ELSE concat('user', CAST(c.c_custkey AS STRING), '@example.com') END AS email,
  CAST(9000000000 + c.c_custkey AS STRING) AS phone, concat(lower(n.n_name), ' ') AS city, r.r_name AS country,
  CAST('2020-01-01' AS DATE) + CAST(c.c_custkey % 365 AS INT) AS signup_date
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN (SELECT 0 AS copy UNION ALL SELECT 1) d ON d.copy = 0 OR c.c_custkey % 10 = 0""",
    "fx_products": """
SELECT CAST(p_partkey AS BIGINT) AS product_id, concat(' ', p_name, ' ') AS product_name, p_type AS category,
  CASE WHEN p_partkey % 50 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS price
FROM part""",
    "fx_wmo": """
SELECT code, descr FROM (VALUES (0,'Clear Sky'),(1,'Mostly Clear'),(2,'Partly Cloudy'),(3,'Cloudy'),
  (45,'Foggy'),(48,'Foggy'),(51,'Light Drizzle'),(53,'Drizzle'),(55,'Heavy Drizzle'),(61,'Light Rain'),
  (63,'Rain'),(65,'Heavy Rain'),(80,'Rain Showers'),(81,'Heavy Showers'),(95,'Thunderstorm'),
  (99,'Thunderstorm with Hail')) AS t(code, descr)""",
    "fx_weather": """
SELECT p.city AS city, p.order_date AS order_date, h.order_hour AS order_hour,
  CAST((n.n_nationkey * 3 + day(p.order_date) + h.order_hour) % 40 AS DOUBLE) AS temperature,
  CAST((n.n_nationkey * 7 + day(p.order_date) * 3 + h.order_hour) % 100 AS INT) AS weather_code,
  COALESCE(w.descr, 'Unknown') AS weather_condition,
  CAST((n.n_nationkey + h.order_hour) % 25 AS DOUBLE) AS wind_speed,
  CAST((day(p.order_date) * 3 + h.order_hour) % 101 AS INT) AS humidity
FROM (SELECT DISTINCT city, CAST(order_time AS DATE) AS order_date FROM fx_orders
      UNION SELECT DISTINCT city, CAST(CAST(timestamp AS TIMESTAMP) AS DATE) FROM fx_stream_orders) p
JOIN nation n ON p.city = n.n_name
CROSS JOIN (SELECT CAST(unnest(range(24)) AS INT) AS order_hour) h
LEFT JOIN fx_wmo w ON w.code = (n.n_nationkey * 7 + day(p.order_date) * 3 + h.order_hour) % 100
WHERE day(p.order_date) % 7 <> 0""",
    "fx_currency": """
SELECT 'INR' AS base_currency, 'USD' AS target_currency, p.order_date AS rate_date,
  CAST(0.011 + day(p.order_date) * 0.0001 AS DECIMAL(10,6)) AS exchange_rate
FROM (SELECT DISTINCT CAST(order_time AS DATE) AS order_date FROM fx_orders
      UNION SELECT DISTINCT CAST(CAST(timestamp AS TIMESTAMP) AS DATE) FROM fx_stream_orders) p
WHERE day(p.order_date) % 10 <> 0""",
    "fx_products_changes": """
SELECT product_id, product_name, category, CAST(round(price * 1.1, 2) AS DECIMAL(18,2)) AS price FROM fx_products WHERE product_id % 3 = 0
UNION ALL SELECT -product_id - 1, product_name, category, price FROM fx_products WHERE product_id % 5 = 0""",
    "fx_customers_next": """
SELECT customer_id, CASE WHEN customer_id % 11 = 0 THEN concat(name, 'x') ELSE name END AS name, email, phone,
  CASE WHEN customer_id % 19 = 0 THEN NULL WHEN customer_id % 7 = 0 THEN 'moved' ELSE city END AS city, country, signup_date
FROM fx_customers WHERE customer_id % 13 <> 0
UNION ALL SELECT -customer_id - 1, name, email, phone, city, country, signup_date FROM fx_customers WHERE customer_id % 17 = 0""",
}
