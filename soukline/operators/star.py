"""Gold star schema: date, location and product dimensions and the order facts.

The fact joins carry no broadcast hints: the dimensions are stored tables, so Spark
knows their size in bytes and broadcasts those below
``spark.sql.autoBroadcastJoinThreshold``; larger ones are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_attributes
from ..functions.timekeys import ts_lit
from ..schemas import DEFAULT_COUNTRY, GOLD_FACT_COLUMNS, LIVE_FACT_COLUMNS
from .keys import with_sequential_id


MAX_DAYS = 200 * 366      # a longer span of order dates means a wrong date, not history


def dim_date(orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """One row per day from the first to the last order date (13 attributes).

    min and max come from one aggregate; the day list is generated from that single
    row with ``sequence`` - no value goes through the driver. No orders, no rows. Dates
    more than ``MAX_DAYS`` apart are an error, raised when the plan runs.
    """
    span = F.datediff(F.max(date_col), F.min(date_col))
    bounds = (orders.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"),
                         span.alias("days"))
              .filter(F.when(F.col("days") > MAX_DAYS, F.raise_error(F.lit(
                  f"order dates are more than {MAX_DAYS} days apart")).cast("boolean"))
                  .otherwise(True)))
    days = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*date_attributes("d"))


def dim_location(orders: DataFrame, existing: DataFrame | None = None,
                 country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Distinct cities with a stable integer ``location_id``.

    New dimension: ids 1..n in city order. Existing dimension: its ids are kept (facts
    already written keep pointing at the right city) and new cities get max+1 onwards.
    """
    cities = orders.select("city").distinct()
    if existing is None:
        return (with_sequential_id(cities, ["city"], "location_id")
                .select("location_id", "city", F.lit(country).alias("country")))
    new = cities.subtract(existing.select("city"))
    top = existing.agg(F.coalesce(F.max("location_id"), F.lit(0))).first()[0]
    added = (with_sequential_id(new, ["city"], "location_id", start=top + 1)
             .select("location_id", "city", F.lit(country).alias("country")))
    return existing.select("location_id", "city", "country").unionByName(added)


def dim_products(products: DataFrame, as_of=None) -> DataFrame:
    """SCD1 product dimension rows stamped with ``updated_at``."""
    return products.select("product_id", "product_name", "category", "price",
                           ts_lit(as_of).alias("updated_at"))


def _dates(dates: DataFrame) -> DataFrame:
    """Date dimension as a join side (stored, so Spark knows its size)."""
    return dates.select(F.col("full_date").alias("order_date"), "date_id")


def fact_orders_gold(fact: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """Silver fact LEFT JOIN date and location dimensions -> surrogate keys."""
    d = _dates(dates)
    loc = locations.select("city", "location_id")
    return (fact.join(d, "order_date", "left").join(loc, "city", "left")
            .select(*GOLD_FACT_COLUMNS))


def fact_live(fact: DataFrame, products: DataFrame, locations: DataFrame,
              dates: DataFrame, as_of=None) -> DataFrame:
    """Live order fact: product, location and date attributes + ``processed_at``."""
    p = products.select("product_id", "product_name", "category")
    loc = locations.select("city", "location_id")
    d = _dates(dates)
    return (fact.join(p, "product_id", "left").join(loc, "city", "left")
            .join(d, "order_date", "left")
            .withColumn("processed_at", ts_lit(as_of))
            .select(*LIVE_FACT_COLUMNS))
