"""The scheduled jobs: rerun is idempotent, a new day only touches its month."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from soukline.plans import flows
from soukline.plans.fixtures import Fixtures
from soukline.session import run_dir
from soukline.sources.files import write_csv
from soukline.sources.tables import read_table

AS_OF = "2024-02-01 00:00:00"


def _snapshot(spark, lake):
    g = flows.gold_tables(spark, lake)
    return {name: sorted(map(str, df.drop("updated_at").collect()))
            for name, df in g.items()}


def test_jobs_rerun_is_idempotent(spark):
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "flows-test")
    dirs = {n: write_csv(df, f"{root}/landing/{n}") for n, df in
            (("customers", fx.customers), ("products", fx.products),
             ("orders", fx.orders.drop("source")))}
    lake = flows.LakePaths(f"{root}/lake")
    flows.ingest_csv(spark, lake, dirs, as_of=AS_OF)
    flows.bronze_to_silver(spark, lake, fx.weather_docs, fx.rate_docs)
    flows.silver_to_gold(spark, lake, as_of=AS_OF)
    first = _snapshot(spark, lake)
    wdir = lake("bronze", "weather").replace("file:", "")
    w_files = sorted((d, os.path.getmtime(os.path.join(wdir, d))) for d in os.listdir(wdir))

    flows.bronze_to_silver(spark, lake, fx.weather_docs, fx.rate_docs)
    flows.silver_to_gold(spark, lake, as_of=AS_OF)
    assert _snapshot(spark, lake) == first
    # nothing was missing the second time: the enrichment store was not rewritten
    assert sorted((d, os.path.getmtime(os.path.join(wdir, d)))
                  for d in os.listdir(wdir)) == w_files

    gold = flows.gold_tables(spark, lake)
    orders = fx.orders.filter("amount > 0").count()
    assert gold["fact_orders"].count() == orders
    assert gold["fact_orders"].filter(F.col("date_id").isNull()).isEmpty()
    assert gold["dim_customers"].filter("is_current").count() == \
        read_table(spark, lake("silver", "dim_customers")).count()


def test_incremental_month_run_touches_only_its_partitions(spark):
    import os
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "flows-incr")
    dirs = {n: write_csv(df, f"{root}/landing/{n}") for n, df in
            (("customers", fx.customers), ("products", fx.products),
             ("orders", fx.orders.drop("source")))}
    lake = flows.LakePaths(f"{root}/lake")
    flows.ingest_csv(spark, lake, dirs, as_of=AS_OF)
    flows.bronze_to_silver(spark, lake, fx.weather_docs, fx.rate_docs)
    flows.silver_to_gold(spark, lake, as_of=AS_OF)
    base = _snapshot(spark, lake)
    fact_dir = lake("gold", "fact_orders").replace("file:", "")
    stamp = {d: os.path.getmtime(os.path.join(fact_dir, d)) for d in os.listdir(fact_dir)
             if d.startswith("order_month=")}
    flows.bronze_to_silver(spark, lake, fx.weather_docs, fx.rate_docs, months=["1998-03"])
    flows.silver_to_gold(spark, lake, as_of=AS_OF, months=["1998-03"])
    assert _snapshot(spark, lake) == base                 # same content
    changed = {d for d, t in stamp.items()
               if os.path.getmtime(os.path.join(fact_dir, d)) != t}
    assert changed == {"order_month=1998-03"}             # one partition rewritten


def test_incremental_csv_ingest_reads_each_file_once(spark):
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "flows-csv-stream")
    lake = flows.LakePaths(f"{root}/lake")
    landing, ckpt = f"{root}/landing/orders", f"{root}/_ckpt/orders"
    orders = fx.orders.drop("source")
    first = orders.filter("order_id % 2 = 0")
    first.write.option("header", True).csv(landing)
    path = flows.ingest_csv_incremental(spark, lake, "orders", landing, ckpt, as_of=AS_OF)
    assert spark.read.parquet(path).count() == first.count()
    # a second drop of files: only the new files are read
    orders.filter("order_id % 2 = 1").write.mode("append").option("header", True).csv(landing)
    flows.ingest_csv_incremental(spark, lake, "orders", landing, ckpt, as_of=AS_OF,
                                 max_files_per_trigger=1)
    flows.ingest_csv_incremental(spark, lake, "orders", landing, ckpt, as_of=AS_OF)  # no-op
    got = spark.read.parquet(path)
    assert got.count() == orders.count()
    assert got.select("order_id").distinct().count() == orders.count()


def test_landed_files_reach_the_tables_that_silver_reads(spark):
    """Two drops of files through the incremental load: a row landed again replaces its key."""
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "flows-landed")
    lake = flows.LakePaths(f"{root}/lake")
    orders = fx.orders.drop("source").filter("order_id % 4 = 0")
    products = fx.products.filter("product_id % 4 = 0")
    for drop, (o, p) in enumerate((
            (orders, products),
            (orders.filter("order_id % 8 = 0").withColumn("amount", F.col("amount") + 1),
             products.withColumn("category", F.lit("again"))))):
        for name, df in (("orders", o), ("products", p)):
            df.write.mode("append").option("header", True).csv(f"{root}/landing/{name}")
            flows.ingest_csv_incremental(spark, lake, name, f"{root}/landing/{name}",
                                         f"{root}/ckpt/{name}", as_of=AS_OF)
            flows.merge_landed(spark, lake, name, f"{root}/ckpt/{name}-merge")
    got = spark.read.parquet(lake("bronze", "orders"))
    assert got.count() == orders.count()
    again = F.when(F.col("order_id") % 8 == 0, F.col("amount") + 1).otherwise(F.col("amount"))
    assert got.agg(F.sum("amount")).first() == orders.agg(F.sum(again)).first()
    stored = read_table(spark, lake("bronze", "products"))
    assert stored.count() == products.count()
    assert {r.category for r in stored.select("category").distinct().collect()} == {"again"}


def test_malformed_lines_are_kept_aside(spark):
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "flows-rejects")
    lake = flows.LakePaths(f"{root}/lake")
    dirs = {n: write_csv(df, f"{root}/landing/{n}") for n, df in
            (("customers", fx.customers), ("products", fx.products),
             ("orders", fx.orders.drop("source")))}
    lines = [",".join(fx.orders.columns[:7]), "x,1,2,3,INR,Pune,2024-01-01 10:00:00", "7,1,2"]
    bad = spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1)
    bad.write.mode("append").text(dirs["orders"])
    flows.ingest_csv(spark, lake, dirs, as_of=AS_OF)
    rejects = read_table(spark, lake("bronze", "orders_rejects")).collect()
    assert sorted(r.line for r in rejects) == sorted(lines[1:])
    assert spark.read.parquet(lake("bronze", "orders")).count() == fx.orders.count()
    assert read_table(spark, lake("bronze", "products_rejects")).count() == 0


def test_second_snapshot_builds_scd2_history_like_the_query(spark):
    """Jobs over two customer snapshots == the registered scd2_customers query."""
    import __spark_entry__ as entry
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "flows-scd2")
    lake = flows.LakePaths(f"{root}/lake")
    orders_dir = write_csv(fx.orders.drop("source"), f"{root}/landing/orders")
    products_dir = write_csv(fx.products, f"{root}/landing/products")
    for i, (snap, as_of) in enumerate(((fx.customers, "2024-01-01 00:00:00"),
                                       (fx.customers_next, "2024-02-01 00:00:00"))):
        cdir = write_csv(snap, f"{root}/landing/customers{i}")
        flows.ingest_csv(spark, lake, {"customers": cdir, "products": products_dir,
                                       "orders": orders_dir}, as_of=as_of)
        flows.bronze_to_silver(spark, lake, fx.weather_docs, fx.rate_docs)
        flows.silver_to_gold(spark, lake, as_of=as_of)
    got = flows.gold_tables(spark, lake)["dim_customers"]
    want = entry.queries()["scd2_customers"](spark, SF_SMALL)
    norm = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert norm(got) == norm(want)


def test_command_line_steps(spark):
    import __spark_entry__ as entry
    from soukline.plans import run
    from soukline.sources.files import land_documents
    fx = Fixtures(spark, SF_SMALL)
    root = run_dir(spark, "cli")
    dirs = {n: write_csv(df, f"{root}/landing/{n}") for n, df in
            (("customers", fx.customers), ("products", fx.products),
             ("orders", fx.orders.drop("source")))}
    wdocs = land_documents(fx.weather_docs, f"{root}/landing/weather_docs")
    rdocs = land_documents(fx.rate_docs, f"{root}/landing/rate_docs")
    lake = f"{root}/lake"
    run.main(["ingest", "--lake", lake, "--customers", dirs["customers"], "--products",
              dirs["products"], "--orders", dirs["orders"], "--as-of", AS_OF], spark)
    run.main(["silver", "--lake", lake, "--weather-docs", wdocs, "--rate-docs", rdocs], spark)
    run.main(["gold", "--lake", lake, "--as-of", AS_OF], spark)
    out = run.main(["report", "--lake", lake], spark)
    want = entry.queries()["lakehouse_end_to_end"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, out["revenue_by_category"].collect())) == \
        sorted(map(tuple, want))
