"""Declared schemas of every table the library reads or writes, and fixed values.

Money is DECIMAL(18,2) and exchange rates DECIMAL(10,6), so sums and rounding are exact
and do not depend on the order rows are added in. Totals use DECIMAL(38,2).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(38, 2)
RATE = T.DecimalType(10, 6)

# ---------------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------------
# WMO weather code -> description; codes not listed map to UNKNOWN_WEATHER.
WMO_CODES = {
    0: "Clear Sky", 1: "Mostly Clear", 2: "Partly Cloudy", 3: "Cloudy",
    45: "Foggy", 48: "Foggy", 51: "Light Drizzle", 53: "Drizzle",
    55: "Heavy Drizzle", 61: "Light Rain", 63: "Rain", 65: "Heavy Rain",
    80: "Rain Showers", 81: "Heavy Showers", 95: "Thunderstorm",
    99: "Thunderstorm with Hail",
}
UNKNOWN_WEATHER = "Unknown"
# Hourly values stored when a weather document is missing or unusable.
WEATHER_FALLBACK = {"temperature": 0.0, "weather_condition": UNKNOWN_WEATHER,
                    "wind_speed": 0.0, "humidity": 0}
HOURS_PER_DOCUMENT = 24
# INR -> USD rate stored when a rate document is missing or has no USD entry.
RATE_FALLBACK = "0.012"
BASE_CURRENCY, TARGET_CURRENCY = "INR", "USD"
# Source tags written by the ingestion jobs.
SOURCE_BATCH, SOURCE_STREAM = "batch_csv", "streaming"
# Phone mask prefix and the visible window (characters 7..10 of the number).
PHONE_MASK, PHONE_VISIBLE_FROM, PHONE_VISIBLE_LEN = "******", 7, 4
# dim_date flags.
WEEKEND_DAYS = (1, 7)          # dayofweek: 1 = Sunday, 7 = Saturday
FESTIVE_MONTHS = (10, 11, 12)
DEFAULT_COUNTRY = "India"
# Producer timestamp text format.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Bronze -------------------------------------------------------------------------
BRONZE_CUSTOMERS = _s(("customer_id", T.LongType()), ("name", T.StringType()),
                      ("email", T.StringType()), ("phone", T.StringType()),
                      ("city", T.StringType()), ("country", T.StringType()),
                      ("signup_date", T.DateType()))
BRONZE_PRODUCTS = _s(("product_id", T.LongType()), ("product_name", T.StringType()),
                     ("category", T.StringType()), ("price", MONEY))
BRONZE_ORDERS = _s(("order_id", T.LongType()), ("customer_id", T.LongType()),
                   ("product_id", T.LongType()), ("amount", MONEY),
                   ("currency", T.StringType()), ("city", T.StringType()),
                   ("order_time", T.TimestampType()))
# JSON body of one stream message (all fields nullable; malformed -> NULL).
STREAM_ORDER = _s(("order_id", T.LongType()), ("customer_id", T.LongType()),
                  ("product_id", T.LongType()), ("amount", MONEY),
                  ("currency", T.StringType()), ("city", T.StringType()),
                  ("timestamp", T.StringType()))
# Where and when a message was queued; in this order messages of a key are first or later.
MESSAGE = _s(("enqueued_at", T.TimestampType()), ("message_partition", T.IntegerType()),
             ("message_offset", T.LongType()))
MESSAGE_ORDER = MESSAGE.fieldNames()
BUFFER_SCHEMA = T.StructType([*STREAM_ORDER.fields, *MESSAGE.fields,
                              T.StructField("ingested_at", T.TimestampType(), True)])
WEATHER = _s(("city", T.StringType()), ("order_date", T.DateType()),
             ("order_hour", T.IntegerType()), ("temperature", T.DoubleType()),
             ("weather_condition", T.StringType()), ("wind_speed", T.DoubleType()),
             ("humidity", T.IntegerType()))
CURRENCY = _s(("base_currency", T.StringType()), ("target_currency", T.StringType()),
              ("rate_date", T.DateType()), ("exchange_rate", RATE))

# Landed HTTP payloads -------------------------------------------------------------
WEATHER_DOC = T.StructType([T.StructField("hourly", _s(
    ("temperature_2m", T.ArrayType(T.DoubleType())),
    ("weathercode", T.ArrayType(T.IntegerType())),
    ("windspeed_10m", T.ArrayType(T.DoubleType())),
    ("relativehumidity_2m", T.ArrayType(T.IntegerType()))))])
RATE_DOC = T.StructType([T.StructField("rates", _s(("USD", RATE)))])
GEOCODE_DOC = T.StructType([T.StructField("results", T.ArrayType(_s(
    ("latitude", T.DoubleType()), ("longitude", T.DoubleType()))))])

# Silver / gold column orders (fixed: the result schemas) ------------------------------------------------------
SILVER_FACT_COLUMNS = [
    "order_id", "customer_id", "product_id", "amount_inr", "amount_usd", "currency",
    "city", "order_time", "order_date", "order_hour", "source", "temperature",
    "weather_condition", "wind_speed", "humidity", "usd_exchange_rate"]
GOLD_FACT_COLUMNS = [
    "order_id", "customer_id", "product_id", "date_id", "location_id", "amount_inr",
    "amount_usd", "currency", "temperature", "weather_condition", "wind_speed",
    "humidity", "usd_exchange_rate", "order_time", "order_date", "source"]
LIVE_FACT_COLUMNS = [
    "order_id", "customer_id", "product_id", "product_name", "category", "location_id",
    "city", "date_id", "order_date", "order_hour", "order_time", "amount_inr",
    "amount_usd", "temperature", "weather_condition", "wind_speed", "humidity",
    "usd_exchange_rate", "source", "processed_at"]
CUSTOMER_COLUMNS = ["customer_id", "name", "email", "phone", "city", "country",
                    "signup_date"]
SCD2_COLUMNS = CUSTOMER_COLUMNS + ["start_date", "end_date", "is_current"]
