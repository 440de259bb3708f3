"""Weather and exchange-rate enrichment.

The HTTP calls of an enrichment run are outside Spark; what they return is landed as
JSON documents (one per (city, date) for weather, one per date for rates, one per city
for geocoding). Everything else - which keys are missing, parsing, hour flattening,
code lookup, fallbacks and the keyed merge into the stored tables - runs here as
DataFrame operations on executors.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timekeys import to_usd, with_time_keys
from ..schemas import (BASE_CURRENCY, GEOCODE_DOC, HOURS_PER_DOCUMENT, RATE, RATE_DOC,
                       RATE_FALLBACK, SILVER_FACT_COLUMNS, TARGET_CURRENCY,
                       UNKNOWN_WEATHER, WEATHER_DOC, WEATHER_FALLBACK, WMO_CODES)
from .merge import upsert

WEATHER_KEYS = ["city", "order_date", "order_hour"]
WEATHER_MEASURES = ["temperature", "weather_condition", "wind_speed", "humidity"]
WEATHER_COLUMNS = WEATHER_KEYS + WEATHER_MEASURES
RATE_KEYS = ["base_currency", "target_currency", "rate_date"]


# -- lookups ----------------------------------------------------------------------
def weather_description(code: Column | str) -> Column:
    """WMO code -> text via a literal map (JVM-side, no join); unknown -> 'Unknown'."""
    c = F.col(code) if isinstance(code, str) else code
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v))
                                              for k, v in WMO_CODES.items()))
    return F.coalesce(F.try_element_at(table, c), F.lit(UNKNOWN_WEATHER))


def usd_rates(currency: DataFrame) -> DataFrame:
    """The INR->USD rows only, as (order_date, usd_exchange_rate).

    Filtering the pair and keeping one rate per day (the largest) keeps the date join
    one-to-one even when the stored table holds other pairs or repeats a day.
    """
    return (currency
            .filter((F.col("base_currency") == BASE_CURRENCY)
                    & (F.col("target_currency") == TARGET_CURRENCY))
            .select(F.col("rate_date").alias("order_date"),
                    F.col("exchange_rate").cast(RATE).alias("usd_exchange_rate"))
            .groupBy("order_date").agg(F.max("usd_exchange_rate").alias("usd_exchange_rate")))


# -- order enrichment (left joins keep every order) ---------------------------------
def join_weather(orders: DataFrame, weather: DataFrame) -> DataFrame:
    """orders LEFT JOIN weather ON (city, order_date, order_hour)."""
    return orders.join(weather.select(*WEATHER_COLUMNS), WEATHER_KEYS, "left")


def join_rate(orders: DataFrame, currency: DataFrame) -> DataFrame:
    """orders LEFT JOIN the INR->USD rate of the order date; adds usd_exchange_rate.

    No hint: a stored rate table has a known size, and Spark broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return orders.join(usd_rates(currency), "order_date", "left")


def enrich_orders(orders: DataFrame, weather: DataFrame, currency: DataFrame) -> DataFrame:
    """Cleaned orders -> the 16-column silver order fact."""
    j = join_rate(join_weather(orders, weather), currency)
    return (j.withColumns({"amount_inr": F.col("amount"),
                           "amount_usd": to_usd("amount", "usd_exchange_rate")})
            .select(*SILVER_FACT_COLUMNS))


def weather_coverage(fact: DataFrame) -> DataFrame:
    """One pass: orders, with weather, without weather."""
    has = F.col("temperature").isNotNull()
    return fact.agg(F.count(F.lit(1)).alias("orders"),
                    F.count_if(has).alias("with_weather"),
                    F.count_if(~has).alias("without_weather"))


# -- gap detection --------------------------------------------------------------------
PAIR = ["city", "order_date"]
ALL_HOURS = (1 << HOURS_PER_DOCUMENT) - 1


def hours_by_pair(rows: DataFrame) -> DataFrame:
    """One row per (city, order_date): ``hours``, a 24-bit mask of the hours that occur.

    A bitwise-or aggregate: a pair with millions of orders is folded to one number inside
    each scan task before anything is shuffled."""
    return (rows.select(*WEATHER_KEYS).dropna().groupBy(*PAIR)
            .agg(F.bit_or(F.expr("shiftleft(1, order_hour)")).alias("hours")))


def missing_hours(orders: DataFrame, coverage: DataFrame | None) -> DataFrame:
    """(city, order_date, hours): hours the orders need that ``coverage`` lacks, as masks.

    ``coverage`` holds a mask per stored pair (:func:`hours_by_pair` of the store, kept
    beside it): the check joins one row per pair, a 24th of the store's rows, and reads no
    hour of the store. An order without a city or a time needs nothing."""
    need = hours_by_pair(with_time_keys(orders, "order_time"))
    if coverage is None:
        return need
    have = coverage.select(*PAIR, F.col("hours").alias("_have"))
    gap = F.col("hours").bitwiseAND(F.bitwise_not(F.coalesce("_have", F.lit(0))))
    return (need.join(have, PAIR, "left").withColumn("hours", gap)
            .filter(F.col("hours") != 0).select(*PAIR, "hours"))


def weather_gaps(orders: DataFrame, stored: DataFrame | None = None,
                 coverage: DataFrame | None = None) -> DataFrame:
    """Distinct (city, order_date, order_hour) the orders need that are not stored.

    Give ``coverage`` where the store has one; without it the masks are taken from all
    stored hours."""
    if coverage is None and stored is not None:
        coverage = hours_by_pair(stored)
    gap = missing_hours(orders, coverage)
    bits = F.filter(_hours(), lambda h: F.getbit("hours", h) == 1)
    return gap.select(*PAIR, F.explode(bits).alias("order_hour"))


def gap_pairs(gaps: DataFrame) -> DataFrame:
    """Gaps -> the (city, order_date) documents to fetch (all 24 hours each)."""
    return gaps.select(*PAIR).distinct()


def rate_gaps(orders: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Order dates with no stored INR->USD rate, as ``rate_date``."""
    need = (with_time_keys(orders, "order_time")
            .select(F.col("order_date").alias("rate_date")).dropna().distinct())
    if stored is None:
        return need
    have = usd_rates(stored).select(F.col("order_date").alias("rate_date"))
    return need.join(have, "rate_date", "left_anti")


# -- payload parsing --------------------------------------------------------------------
def _hours() -> Column:
    return F.sequence(F.lit(0), F.lit(HOURS_PER_DOCUMENT - 1))


def _hourly_rows(doc: Column) -> Column:
    """array<struct> of 24 hourly rows from one parsed weather document (or fallback).

    A document is usable when all four arrays have at least 24 elements and none of the
    first 24 is NULL; anything else (missing document, bad JSON, short or holed array)
    yields the 24 fallback rows, flagged ``is_fallback``. ``doc`` must be a column that
    already holds the parsed struct, so the JSON text is parsed once per document.
    """
    h = doc["hourly"]
    arrays = [h["temperature_2m"], h["weathercode"], h["windspeed_10m"],
              h["relativehumidity_2m"]]
    ok = F.lit(True)
    for a in arrays:
        ok = ok & F.coalesce((F.size(a) >= HOURS_PER_DOCUMENT)
                             & ~F.exists(F.slice(a, 1, HOURS_PER_DOCUMENT),
                                         lambda x: x.isNull()), F.lit(False))
    temp, code, wind, hum = arrays

    def parsed(i):
        return F.struct(i.alias("order_hour"),
                        F.try_element_at(temp, i + 1).cast("double").alias("temperature"),
                        weather_description(F.try_element_at(code, i + 1))
                        .alias("weather_condition"),
                        F.try_element_at(wind, i + 1).cast("double").alias("wind_speed"),
                        F.try_element_at(hum, i + 1).cast("int").alias("humidity"),
                        F.lit(False).alias("is_fallback"))

    def fallback(i):
        fb = WEATHER_FALLBACK
        return F.struct(i.alias("order_hour"),
                        F.lit(fb["temperature"]).cast("double").alias("temperature"),
                        F.lit(fb["weather_condition"]).alias("weather_condition"),
                        F.lit(fb["wind_speed"]).cast("double").alias("wind_speed"),
                        F.lit(fb["humidity"]).cast("int").alias("humidity"),
                        F.lit(True).alias("is_fallback"))

    return F.when(ok, F.transform(_hours(), parsed)).otherwise(F.transform(_hours(), fallback))


def flatten_hourly(docs: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Weather documents (city, order_date, payload) -> 24 typed rows per document."""
    parsed = docs.select("city", "order_date",
                         F.from_json(F.col(payload_col), WEATHER_DOC).alias("_doc"))
    return parsed.select("city", "order_date", F.inline(_hourly_rows(F.col("_doc"))))


def fill_weather(pairs: DataFrame, docs: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Requested (city, order_date) pairs -> 24 rows each, parsed or fallback.

    One join on (city, order_date) - documents are one per pair - and a generator for
    the hours; no hour-level join and no cross join.
    """
    parsed = docs.select("city", "order_date",
                         F.from_json(F.col(payload_col), WEATHER_DOC).alias("_doc"))
    j = pairs.join(parsed, ["city", "order_date"], "left")
    return j.select("city", "order_date", F.inline(_hourly_rows(F.col("_doc"))))


def fill_rates(dates: DataFrame, docs: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Requested ``rate_date``s -> INR->USD rows; missing/unusable rate -> 0.012."""
    j = dates.join(docs.select("rate_date", payload_col), "rate_date", "left")
    usd = F.from_json(F.col(payload_col), RATE_DOC)["rates"]["USD"]
    return j.select(F.lit(BASE_CURRENCY).alias("base_currency"),
                    F.lit(TARGET_CURRENCY).alias("target_currency"),
                    "rate_date",
                    F.coalesce(usd, F.lit(RATE_FALLBACK).cast(RATE)).alias("exchange_rate"),
                    usd.isNull().alias("is_fallback"))


def geocode_first(docs: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Geocode documents (city, payload) -> first result's coordinates or NULLs."""
    first = F.try_element_at(F.from_json(F.col(payload_col), GEOCODE_DOC)["results"],
                             F.lit(1))
    return docs.select("city", first["latitude"].alias("latitude"),
                       first["longitude"].alias("longitude"))


# -- one enrichment run -------------------------------------------------------------
def enrich_weather(orders: DataFrame, stored: DataFrame | None, docs: DataFrame,
                   coverage: DataFrame | None = None) -> DataFrame:
    """Gap -> fetch list -> parse/fallback -> keyed merge into the stored weather.

    ``stored`` carries ``is_fallback``; the result is the new stored table. An empty
    gap is a no-op merge, so the run can always be executed.
    """
    if coverage is None and stored is not None:
        coverage = hours_by_pair(stored)
    filled = fill_weather(gap_pairs(missing_hours(orders, coverage)), docs)
    return upsert(stored, filled, WEATHER_KEYS)


def enrich_rates(orders: DataFrame, stored: DataFrame | None, docs: DataFrame) -> DataFrame:
    """Missing dates -> parse/fallback -> keyed merge into the stored rates."""
    filled = fill_rates(rate_gaps(orders, stored), docs)
    return upsert(stored, filled, RATE_KEYS)
