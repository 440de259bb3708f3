"""Named KPI and audit reports over the silver and gold tables.

Every report is one aggregate plan (partial aggregation on the map side, then one
shuffle of per-group partials). Money totals are exact DECIMAL(38,2); averages are
``round(sum / count, 2)`` in decimal. Top-k reports break ties on the group key so
the result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timekeys import date_lit
from ..schemas import TOTAL


def money_sum(c: str) -> Column:
    return F.round(F.sum(c), 2).cast(TOTAL)


def on_day(df: DataFrame, as_of=None, col: str = "order_date") -> DataFrame:
    """The "today" view: rows of day ``as_of``; ``None`` keeps every row.

    The live tables are never cleared, so a KPI titled "today" needs this filter; with a
    date-partitioned table it prunes to one partition.
    """
    return df if as_of is None else df.filter(F.col(col) == date_lit(as_of))


def _orders_revenue(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("order_id").alias("orders"),
                               money_sum("amount_inr").alias("revenue_inr"))


# -- live KPIs (gold live fact) -------------------------------------------------------
def live_totals(live: DataFrame, as_of=None) -> DataFrame:
    """Q1: orders, INR and USD revenue, average order value."""
    live = on_day(live, as_of)
    return live.agg(
        F.count("order_id").alias("total_orders"),
        money_sum("amount_inr").alias("revenue_inr"),
        money_sum("amount_usd").alias("revenue_usd"),
        F.round(F.sum("amount_inr") / F.count("amount_inr"), 2).cast(TOTAL)
        .alias("avg_order_value_inr"))


def live_top_cities(live: DataFrame, k: int = 5, as_of=None) -> DataFrame:
    """Q2: top-k cities by INR revenue (top-k is the feature)."""
    live = on_day(live, as_of)
    return (_orders_revenue(live, "city")
            .orderBy(F.col("revenue_inr").desc_nulls_last(), F.col("city").asc_nulls_first())
            .limit(k))


def live_by_category(live: DataFrame, as_of=None) -> DataFrame:
    """Q3: orders and INR revenue per category, by revenue."""
    live = on_day(live, as_of)
    return (_orders_revenue(live, "category")
            .orderBy(F.col("revenue_inr").desc_nulls_last(), "category"))


def live_by_hour(live: DataFrame, as_of=None) -> DataFrame:
    """Q4: orders per hour of day."""
    live = on_day(live, as_of)
    return (live.groupBy("order_hour").agg(F.count("order_id").alias("orders"))
            .orderBy("order_hour"))


def live_by_weather(live: DataFrame, as_of=None) -> DataFrame:
    """Q5: orders and INR revenue per weather condition (NULL group kept)."""
    live = on_day(live, as_of)
    return (_orders_revenue(live, "weather_condition")
            .orderBy(F.col("orders").desc(), "weather_condition"))


KPI_SETS = {"totals": [], "top_cities": ["city"], "by_category": ["category"],
            "by_hour": ["order_hour"], "by_weather": ["weather_condition"]}


def kpi_refresh(live: DataFrame, k: int = 5, as_of=None) -> DataFrame:
    """Q1-Q5 in one pass over the live fact: ``kpi, key, orders, revenue_inr, revenue_usd,
    avg_order_value_inr``.

    One scan feeds all five through GROUPING SETS; each row is folded into the groups of its
    task before anything is shuffled. ``key`` is the group as text (NULL for the totals, and
    for orders without the attribute); only the first ``k`` cities by revenue are listed.
    An empty fact has no rows.
    """
    live = on_day(live, as_of)
    dims = [c for cols in KPI_SETS.values() for c in cols]
    sets = live.groupingSets([[F.col(c) for c in cols] for cols in KPI_SETS.values()],
                             *[F.col(c) for c in dims])
    rows = sets.agg(
        F.grouping_id().alias("_set"), F.count("order_id").alias("orders"),
        money_sum("amount_inr").alias("revenue_inr"), money_sum("amount_usd").alias("revenue_usd"),
        F.round(F.sum("amount_inr") / F.count("amount_inr"), 2).cast(TOTAL)
        .alias("avg_order_value_inr"))
    # a bit of grouping_id says that a dimension is not grouped by, the first one highest
    name, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kpi, cols in KPI_SETS.items():
        code = sum(1 << (len(dims) - 1 - i) for i, c in enumerate(dims) if c not in cols)
        name = F.when(F.col("_set") == code, kpi).otherwise(name)
        if cols:
            key = F.when(F.col("_set") == code, F.col(cols[0]).cast("string")).otherwise(key)
    place = F.row_number().over(Window.partitionBy("kpi").orderBy(
        F.col("revenue_inr").desc_nulls_last(), F.col("key").asc_nulls_first()))
    # the window ranks groups, not orders: a row per city, category, hour and condition
    return (rows.select(name.alias("kpi"), key.alias("key"), "orders", "revenue_inr",
                        "revenue_usd", "avg_order_value_inr")
            .withColumn("_place", place)
            .filter((F.col("kpi") != "top_cities") | (F.col("_place") <= k)).drop("_place"))


# -- gold ---------------------------------------------------------------------------
def revenue_by_category(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Q6: fact INNER JOIN product dim; INR revenue in thousands and USD revenue."""
    j = fact.select("product_id", "amount_inr", "amount_usd").join(
        products.select("product_id", "category"), "product_id")
    return (j.groupBy("category").agg(
        F.round(F.sum("amount_inr") / 1000, 2).cast(TOTAL).alias("revenue_inr_thousands"),
        money_sum("amount_usd").alias("revenue_usd"))
        .orderBy(F.col("revenue_inr_thousands").desc_nulls_last(), "category"))


def orders_by_source(orders: DataFrame) -> DataFrame:
    """Q7: order rows per source tag."""
    return orders.groupBy("source").agg(F.count(F.lit(1)).alias("orders")).orderBy("source")


def buffer_by_date(buffer: DataFrame) -> DataFrame:
    """Q8: buffered stream orders per calendar date of their timestamp text."""
    return (buffer.groupBy(F.to_date(F.try_to_timestamp("timestamp")).alias("date"))
            .agg(F.count(F.lit(1)).alias("orders")).orderBy("date"))


def last_dates(orders: DataFrame, k: int = 5) -> DataFrame:
    """Q9: the k latest order dates with their order counts."""
    return (orders.groupBy(F.date_format("order_time", "yyyy-MM-dd").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("order_date").desc_nulls_last()).limit(k))


# -- silver streaming ----------------------------------------------------------------
def top_cities_by_count(fact: DataFrame, k: int = 5, as_of=None) -> DataFrame:
    """Q10: top-k cities by order count."""
    fact = on_day(fact, as_of)
    return (fact.groupBy("city").agg(F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("orders").desc(), F.col("city").asc_nulls_first()).limit(k))


def live_revenue(fact: DataFrame, as_of=None) -> DataFrame:
    """Q11: INR and USD revenue so far."""
    fact = on_day(fact, as_of)
    return fact.agg(money_sum("amount_inr").alias("total_inr"),
                    money_sum("amount_usd").alias("total_usd"))


def weather_distribution(fact: DataFrame, as_of=None) -> DataFrame:
    """Q12: orders per weather condition."""
    fact = on_day(fact, as_of)
    return (fact.groupBy("weather_condition").agg(F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("orders").desc(), "weather_condition"))


def scd2_counts(dim: DataFrame) -> DataFrame:
    """Q13: total, current and historical versions in one pass."""
    cur = F.coalesce(F.col("is_current"), F.lit(False))
    return dim.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(cur).alias("current_rows"),
                   F.count_if(~cur).alias("historical_rows"))


# -- audits ---------------------------------------------------------------------------
AUDIT_PAYLOAD = ["customer_id", "product_id", "amount", "currency", "city", "order_time"]


def _payload(cols: list[str]) -> Column:
    """A row's payload as one comparable string (NULL-safe, engine-independent text)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>"))
                             for c in cols])


def merge_audit(batch: DataFrame, stream: DataFrame, after: DataFrame,
                key: str = "order_id", payload: list[str] | None = None) -> DataFrame:
    """Before / stream rows / duplicate ids / new ids / after / payload conflicts.

    Duplicate and new ids are the ``INTERSECT`` and ``EXCEPT`` of the id sets; a payload
    conflict is a duplicate id whose stream payload differs from the stored one (an id
    reused for another order - the insert-only merge skips it, so it is reported).
    ``after`` is the stored result, of which only the rows are counted. Ids alone decide
    which rows can conflict; the payload travels only for ids that the stream has.
    """
    p = _payload(payload or AUDIT_PAYLOAD)
    ids = stream.select(key).distinct()
    shared = batch.join(ids, key, "left_semi").select(key, p.alias("_p")).groupBy(key).agg(
        F.min("_p").alias("lo_b"), F.max("_p").alias("hi_b"))
    sent = stream.select(key, p.alias("_p")).groupBy(key).agg(
        F.count(F.lit(1)).alias("ns"), F.min("_p").alias("lo_s"), F.max("_p").alias("hi_s"))
    met = sent.join(shared, key, "left")
    both = F.col("lo_b").isNotNull()
    differs = (F.col("lo_b") != F.col("lo_s")) | (F.col("hi_b") != F.col("hi_s"))
    counts = met.agg(F.coalesce(F.sum("ns"), F.lit(0)).cast("bigint").alias("stream_rows"),
                     F.count_if(both).alias("duplicate_ids"),
                     F.count_if(~both).alias("new_ids"),
                     F.count_if(both & differs).alias("payload_conflicts"))
    # three one-row aggregates side by side, joined on a constant key
    one = F.lit(1).alias("_k")
    rows = lambda df, name: df.agg(F.count(F.lit(1)).alias(name)).select(one, name)
    return (rows(batch, "batch_before").join(counts.select(one, "*"), "_k")
            .join(rows(after, "after"), "_k")
            .select("batch_before", "stream_rows", "duplicate_ids", "new_ids", "after",
                    "payload_conflicts"))


# A silver email/phone that still looks raw: two visible characters before '@', or a
# bare 10-digit number.
RAW_EMAIL, RAW_PHONE = "^[^*@]{2,}@", "^[0-9]{10}$"


def unmasked_pii(customers: DataFrame) -> DataFrame:
    """Customer rows whose email or phone is not masked (the PII check; expect 0)."""
    return customers.filter(F.col("email").rlike(RAW_EMAIL) | F.col("phone").rlike(RAW_PHONE))


def layer_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every named table, one union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def layer_samples(tables: dict[str, tuple[DataFrame, str, str]], n: int = 5) -> DataFrame:
    """The ``n`` rows with the smallest ids of every table: ``table_name, id, label``.

    ``tables`` maps a name to (table, id column, label column)."""
    out = None
    for name, (df, key, label) in tables.items():
        part = (df.orderBy(key).limit(n)
                .select(F.lit(name).alias("table_name"), F.col(key).cast("long").alias("id"),
                        F.col(label).alias("label")))
        out = part if out is None else out.unionByName(part)
    return out
