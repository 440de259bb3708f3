"""Command-line entry point for the scheduled jobs (``spark-submit`` or ``python -m``).

    python -m soukline.plans.run ingest --lake ROOT --customers DIR --products DIR --orders DIR
    python -m soukline.plans.run silver --lake ROOT --weather-docs DIR --rate-docs DIR [--months 2024-01]
    python -m soukline.plans.run gold   --lake ROOT [--as-of "2024-02-01 00:00:00"] [--months 2024-01]
    python -m soukline.plans.run merge         --lake ROOT [--max-files 100]
    python -m soukline.plans.run silver-stream --lake ROOT --weather-docs DIR --rate-docs DIR
    python -m soukline.plans.run live          --lake ROOT [--months 2024-01]
    python -m soukline.plans.run report --lake ROOT

``merge``, ``silver-stream`` and ``live`` work on the buffer table that ``flows.land_messages``
appends to.

Documents are JSON Lines landed with ``sources.files.land_documents`` (weather: city,
order_date, payload; rates: rate_date, payload). On a cluster the session comes from
``spark-submit`` and must name ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..session import build_session, ensure_conf
from ..sources.files import document_scan
from . import flows
from . import reports as rp

WEATHER_KEYS = T.StructType([T.StructField("city", T.StringType()),
                             T.StructField("order_date", T.DateType())])
RATE_KEYS = T.StructType([T.StructField("rate_date", T.DateType())])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="soukline.plans.run")
    ap.add_argument("step", choices=["ingest", "silver", "gold", "merge", "silver-stream", "live", "report"])
    ap.add_argument("--lake", required=True)
    ap.add_argument("--customers"), ap.add_argument("--products"), ap.add_argument("--orders")
    ap.add_argument("--weather-docs"), ap.add_argument("--rate-docs")
    ap.add_argument("--months", help="comma-separated yyyy-MM list (incremental run)")
    ap.add_argument("--as-of", help="pins ingested_at / updated_at / SCD2 dates")
    ap.add_argument("--max-files", type=int, help="files per micro-batch")
    a = ap.parse_args(argv)
    spark = ensure_conf(spark or build_session())
    lake = flows.LakePaths(a.lake)
    months = a.months.split(",") if a.months else None

    def docs():
        return (document_scan(spark, a.weather_docs, WEATHER_KEYS),
                document_scan(spark, a.rate_docs, RATE_KEYS))

    if a.step == "ingest":
        flows.ingest_csv(spark, lake, {"customers": a.customers, "products": a.products,
                                       "orders": a.orders}, as_of=a.as_of)
    elif a.step == "silver":
        flows.bronze_to_silver(spark, lake, *docs(), months=months, as_of=a.as_of)
    elif a.step == "merge":
        flows.merge_stream_orders(spark, lake, a.max_files)
    elif a.step == "silver-stream":
        flows.stream_to_silver(spark, lake, *docs(), as_of=a.as_of,
                               max_files_per_trigger=a.max_files)
    elif a.step == "live":
        flows.silver_to_live(spark, lake, as_of=a.as_of, months=months)
    elif a.step == "gold":
        flows.silver_to_gold(spark, lake, as_of=a.as_of, months=months)
    else:                                  # console sink: print the small reports
        gold = flows.gold_tables(spark, lake)
        out = {"revenue_by_category": rp.revenue_by_category(gold["fact_orders"],
                                                             gold["dim_products"]),
               "scd2_counts": rp.scd2_counts(gold["dim_customers"])}
        for name, df in out.items():
            print(name)
            df.show(truncate=False)
        return out
    return {"step": a.step, "lake": a.lake}


if __name__ == "__main__":
    main()
