"""Silver cleaning of the bronze customers, products and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masking import mask_all_pii
from ..functions.timekeys import parse_ts, with_time_keys
from ..schemas import MONEY, SOURCE_STREAM
from .keys import dedup_by_key

ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "amount", "currency", "city",
                 "order_time", "source"]


def clean_customers(df: DataFrame, mask: bool = True) -> DataFrame:
    """Typed, trimmed, title-cased customers; id and email required; one row per id.

    Filters run before the de-duplication so a NULL-email copy can never be the one
    that survives and make the customer vanish. Of several copies the one with the
    fewest NULLs stays; ties go to the smallest row.
    """
    out = (df.select(
        F.col("customer_id").cast("long").alias("customer_id"),
        normalize_text("name").alias("name"),
        F.trim(F.col("email")).alias("email"),
        F.col("phone").cast("string").alias("phone"),
        normalize_text("city").alias("city"),
        F.trim(F.col("country")).alias("country"),
        F.to_date(F.col("signup_date")).alias("signup_date"))
        .filter(F.col("customer_id").isNotNull() & F.col("email").isNotNull()))
    missing = sum((F.col(c).isNull().cast("int") for c in out.columns), F.lit(0))
    out = dedup_by_key(out.withColumn("_missing", missing), ["customer_id"],
                       order_by=["_missing"]).drop("_missing")
    return mask_all_pii(out) if mask else out


def clean_products(df: DataFrame) -> DataFrame:
    """Typed, trimmed products with a positive price; one row per id."""
    out = (df.select(
        F.col("product_id").cast("long").alias("product_id"),
        F.trim(F.col("product_name")).alias("product_name"),
        F.trim(F.col("category")).alias("category"),
        F.col("price").cast(MONEY).alias("price"))
        .filter(F.col("product_id").isNotNull() & (F.col("price") > 0)))
    return dedup_by_key(out, ["product_id"])


def normalize_text(c: str):
    """Title case, trimmed - the customer-city normaliser, reusable for orders."""
    return F.trim(F.initcap(F.col(c)))


def clean_orders(df: DataFrame, normalize_city: bool = False) -> DataFrame:
    """Orders with ``order_date``/``order_hour``, an id, a positive amount; one per id
    (the newest by ``order_time``, ties to the largest row).

    The order city stays as landed by default (the weather store is keyed on it);
    ``normalize_city=True`` applies the same normaliser as the customer city.
    """
    if normalize_city:
        df = df.withColumn("city", normalize_text("city"))
    out = (with_time_keys(df, "order_time")
           .filter(F.col("order_id").isNotNull() & (F.col("amount") > 0)))
    return dedup_by_key(out, ["order_id"], order_by=["order_time"], keep="last")


def stream_order_rejects(buffer: DataFrame) -> DataFrame:
    """Buffered stream rows whose timestamp text does not parse (they get a NULL
    ``order_time`` instead of failing the job; this returns them for inspection)."""
    return (buffer.withColumn("_ts", parse_ts("timestamp"))
            .filter(F.col("_ts").isNull() & F.col("timestamp").isNotNull()).drop("_ts"))


def align_stream_orders(df: DataFrame, source: str = SOURCE_STREAM,
                        keep: tuple[str, ...] = ()) -> DataFrame:
    """Stream buffer rows -> the bronze order layout.

    ``timestamp`` text becomes a TIMESTAMP ``order_time`` (unparseable text -> NULL
    rather than failing the job) and the rows are tagged with ``source``. ``keep``: further
    columns to carry along.
    """
    cols = {"order_time": parse_ts("timestamp"), "source": F.lit(source)}
    return df.withColumns(cols).select(*ORDER_COLUMNS, *keep)


def clean_stream_orders(df: DataFrame) -> DataFrame:
    """Stream buffer -> cleaned orders (same rules as the batch orders)."""
    return clean_orders(align_stream_orders(df))
