"""Independent SQL statements of every registered query (the DuckDB oracle).

Each statement is assembled as ``WITH <the CTEs it needs> <select>`` from the fixture
SQL of ``fixtures.FIXTURE_SQL`` and the CTEs below; nothing here is shared with the
Spark implementation except the fixture text. Deterministic de-duplication uses
``row_number()`` with the same tie order the Spark operator uses (all columns,
NULL first).
"""

from __future__ import annotations

import re

from .fixtures import FIXTURE_SQL

AS_OF_TS = "2024-02-01 00:00:00"
AS_OF_DATE = "2024-02-01"
SCD2_START = "2024-01-01"
KPI_DAY = "2024-01-10"


def _initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1:1]) || lower(w[2:])), ' ')")


def _email_mask(x: str) -> str:
    return (f"CASE WHEN instr({x}, '@') > 1 THEN substr({x}, 1, 1) || "
            f"repeat('*', instr({x}, '@') - 2) || substr({x}, instr({x}, '@')) "
            f"ELSE repeat('*', length({x})) END")


def _phone_mask(x: str) -> str:
    return f"'******' || substr(CAST({x} AS VARCHAR), 7, 4)"


def _money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DECIMAL(38,2))"


def _avg_money(x: str) -> str:
    """round(sum/count, 2) half-up, exact (integer cents; the values are positive)."""
    return (f"CAST(CAST((CAST(sum({x}) * 100 AS HUGEINT) * 2 + count({x})) // "
            f"(2 * count({x})) AS DECIMAL(38,0)) * 0.01 AS DECIMAL(38,2))")


def _payload_sql() -> str:
    cols = ["customer_id", "product_id", "amount", "currency", "city", "order_time"]
    return "concat_ws('|', " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in cols) + ")"


def _clean_customers(src: str) -> str:
    return f"""
SELECT customer_id, name, {_email_mask('email')} AS email, {_phone_mask('phone')} AS phone,
  city, country, signup_date
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY
        (name IS NULL)::INT + (email IS NULL)::INT + (phone IS NULL)::INT + (city IS NULL)::INT
        + (country IS NULL)::INT + (signup_date IS NULL)::INT, name NULLS FIRST,
        email NULLS FIRST, phone NULLS FIRST, city NULLS FIRST, country NULLS FIRST,
        signup_date NULLS FIRST) AS rn
      FROM (SELECT CAST(customer_id AS BIGINT) AS customer_id, trim({_initcap('lower(name)')}) AS name,
              trim(email) AS email, CAST(phone AS VARCHAR) AS phone,
              trim({_initcap('lower(city)')}) AS city, trim(country) AS country,
              CAST(signup_date AS DATE) AS signup_date FROM {src}) t
      WHERE customer_id IS NOT NULL AND email IS NOT NULL) u
WHERE rn = 1"""


def with_gaps_sql() -> str:
    """Customers beside copies of themselves with missing fields, cleaned."""
    source = """(SELECT * FROM fx_customers
      UNION ALL SELECT customer_id, CAST(NULL AS VARCHAR), email, phone, CAST(NULL AS VARCHAR),
        country, signup_date FROM fx_customers WHERE customer_id % 2 = 0
      UNION ALL SELECT customer_id, name, email, CAST(NULL AS VARCHAR), city, country,
        CAST(NULL AS DATE) FROM fx_customers WHERE customer_id % 3 = 0)"""
    return _clean_customers(source)


def _clean_products(src: str) -> str:
    return f"""
SELECT product_id, product_name, category, price
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS FIRST,
        category NULLS FIRST, price NULLS FIRST) AS rn
      FROM (SELECT CAST(product_id AS BIGINT) AS product_id, trim(product_name) AS product_name,
              trim(category) AS category, CAST(price AS DECIMAL(18,2)) AS price FROM {src}) t
      WHERE product_id IS NOT NULL AND price > 0) u
WHERE rn = 1"""


def _clean_orders(src: str) -> str:
    return f"""
SELECT order_id, customer_id, product_id, amount, currency, city, order_time, source,
  order_date, order_hour
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_time DESC NULLS LAST,
        customer_id DESC NULLS LAST, product_id DESC NULLS LAST, amount DESC NULLS LAST,
        currency DESC NULLS LAST, city DESC NULLS LAST, source DESC NULLS LAST) AS rn
      FROM (SELECT *, CAST(order_time AS DATE) AS order_date,
              CAST(hour(order_time) AS INT) AS order_hour FROM {src}) t
      WHERE order_id IS NOT NULL AND amount > 0) u
WHERE rn = 1"""


def _silver_fact(src: str) -> str:
    return f"""
SELECT o.order_id, o.customer_id, o.product_id, o.amount AS amount_inr,
  CAST(round(o.amount * r.exchange_rate, 2) AS DECIMAL(18,2)) AS amount_usd,
  o.currency, o.city, o.order_time, o.order_date, o.order_hour, o.source,
  w.temperature, w.weather_condition, w.wind_speed, w.humidity,
  r.exchange_rate AS usd_exchange_rate
FROM {src} o
LEFT JOIN fx_weather w ON o.city = w.city AND o.order_date = w.order_date
  AND o.order_hour = w.order_hour
LEFT JOIN usd r ON o.order_date = r.rate_date"""


def _fallback_hours(pairs: str) -> str:
    return f"""
SELECT p.city, p.order_date, CAST(h.order_hour AS INT) AS order_hour, CAST(0.0 AS DOUBLE) AS temperature,
  'Unknown' AS weather_condition, CAST(0.0 AS DOUBLE) AS wind_speed, CAST(0 AS INT) AS humidity,
  true AS is_fallback
FROM {pairs} p, (SELECT unnest(range(24)) AS order_hour) h"""


CTE: dict[str, str] = dict(FIXTURE_SQL)
CTE.update({
    "usd": "SELECT rate_date, exchange_rate FROM fx_currency "
           "WHERE base_currency = 'INR' AND target_currency = 'USD'",
    "c_customers": _clean_customers("fx_customers"),
    "c_customers_next": _clean_customers("fx_customers_next"),
    "c_products": _clean_products("fx_products"),
    "c_products_changes": _clean_products("fx_products_changes"),
    "c_orders": _clean_orders("fx_orders"),
    "a_stream": "SELECT order_id, customer_id, product_id, amount, currency, city, "
                "TRY_CAST(timestamp AS TIMESTAMP) AS order_time, 'streaming' AS source "
                "FROM fx_stream_orders",
    "c_stream": _clean_orders("a_stream"),
    "q_stream": "SELECT *, TRY_CAST(timestamp AS TIMESTAMP) + INTERVAL 1 SECOND AS enqueued_at, "
                "CAST((order_id // 2) % 4 AS INT) AS message_partition, "
                "(order_id // 2) // 4 AS message_offset FROM fx_stream_orders",
    "s_fact": _silver_fact("c_orders"),
    "s_stream": _silver_fact("c_stream"),
    "g_dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS full_date,
  strftime(d, '%Y-%m-%d') AS date_str, CAST(year(d) AS INT) AS year,
  CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
  monthname(d) AS month_name, CAST(weekofyear(d) AS INT) AS week_of_year,
  CAST(day(d) AS INT) AS day_of_month, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
  dayname(d) AS day_name, dayofweek(d) + 1 IN (1, 7) AS is_weekend,
  month(d) IN (10, 11, 12) AS is_festive_season
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM s_fact) b) t""",
    "g_dim_location": """
SELECT CAST(row_number() OVER (ORDER BY city NULLS FIRST) AS BIGINT) AS location_id, city,
  'India' AS country
FROM (SELECT DISTINCT city FROM s_fact) t""",
    "g_dim_products": f"""
SELECT product_id, product_name, category, price, TIMESTAMP '{AS_OF_TS}' AS updated_at
FROM c_products""",
    "g_fact": """
SELECT f.order_id, f.customer_id, f.product_id, d.date_id, l.location_id, f.amount_inr,
  f.amount_usd, f.currency, f.temperature, f.weather_condition, f.wind_speed, f.humidity,
  f.usd_exchange_rate, f.order_time, f.order_date, f.source
FROM s_fact f LEFT JOIN g_dim_date d ON f.order_date = d.full_date
LEFT JOIN g_dim_location l ON f.city = l.city""",
    "g_live": f"""
SELECT f.order_id, f.customer_id, f.product_id, p.product_name, p.category, l.location_id,
  f.city, d.date_id, f.order_date, f.order_hour, f.order_time, f.amount_inr, f.amount_usd,
  f.temperature, f.weather_condition, f.wind_speed, f.humidity, f.usd_exchange_rate,
  f.source, TIMESTAMP '{AS_OF_TS}' AS processed_at
FROM s_stream f LEFT JOIN g_dim_products p ON f.product_id = p.product_id
LEFT JOIN g_dim_location l ON f.city = l.city
LEFT JOIN g_dim_date d ON f.order_date = d.full_date""",
    "m_orders": """
SELECT * FROM fx_orders
UNION ALL
SELECT * FROM (SELECT order_id, customer_id, product_id, amount, currency, city, order_time, source
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST,
          product_id NULLS FIRST, amount NULLS FIRST, currency NULLS FIRST, city NULLS FIRST,
          order_time NULLS FIRST, source NULLS FIRST) AS rn FROM a_stream) s
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM fx_orders b WHERE b.order_id = s.order_id))""",
    "scd2_existing": f"""
SELECT *, DATE '{SCD2_START}' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current
FROM c_customers""",
    "scd2_result": f"""
SELECT e.customer_id, e.name, e.email, e.phone, e.city, e.country, e.signup_date, e.start_date,
  CASE WHEN n.city IS NOT NULL AND e.city <> n.city THEN DATE '{AS_OF_DATE}' ELSE e.end_date END AS end_date,
  CASE WHEN n.city IS NOT NULL AND e.city <> n.city THEN false ELSE e.is_current END AS is_current
FROM scd2_existing e LEFT JOIN c_customers_next n ON e.customer_id = n.customer_id
UNION ALL
SELECT n.*, DATE '{AS_OF_DATE}' AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current
FROM c_customers_next n
WHERE NOT EXISTS (SELECT 1 FROM scd2_existing e WHERE e.customer_id = n.customer_id
                  AND NOT coalesce(e.city <> n.city, false))
  OR n.customer_id IS NULL""",
    "w_need": "SELECT DISTINCT city, CAST(order_time AS DATE) AS order_date, "
              "CAST(hour(order_time) AS INT) AS order_hour FROM fx_orders",
    "w_gaps": "SELECT * FROM w_need EXCEPT SELECT city, order_date, order_hour FROM fx_weather",
    "w_pairs": "SELECT DISTINCT city, order_date FROM w_gaps",
    "order_pairs": "SELECT DISTINCT city, CAST(order_time AS DATE) AS order_date FROM fx_orders",
    "parsed_weather": "SELECT city, order_date, order_hour, temperature, weather_condition, "
                      "wind_speed, humidity, false AS is_fallback FROM fx_weather",
    "weather_filled": f"""
SELECT w.* FROM parsed_weather w JOIN order_pairs p ON w.city = p.city AND w.order_date = p.order_date
UNION ALL
SELECT * FROM ({_fallback_hours('(SELECT * FROM order_pairs p WHERE NOT EXISTS (SELECT 1 FROM fx_weather w WHERE w.city = p.city AND w.order_date = p.order_date))')}) f""",
    "enrich_stored": "SELECT * FROM parsed_weather WHERE day(order_date) % 3 <> 0",
    "enrich_pairs": """
SELECT DISTINCT city, order_date FROM (
  SELECT * FROM w_need EXCEPT SELECT city, order_date, order_hour FROM enrich_stored) g""",
    "enrich_result": f"""
SELECT * FROM enrich_stored
UNION ALL
SELECT w.* FROM parsed_weather w JOIN enrich_pairs p ON w.city = p.city AND w.order_date = p.order_date
UNION ALL
SELECT * FROM ({_fallback_hours('(SELECT * FROM enrich_pairs p WHERE NOT EXISTS (SELECT 1 FROM fx_weather w WHERE w.city = p.city AND w.order_date = p.order_date))')}) f""",
    "u_products": """
SELECT * FROM c_products t WHERE NOT EXISTS (
  SELECT 1 FROM c_products_changes s WHERE s.product_id = t.product_id)
UNION ALL SELECT * FROM c_products_changes""",
})

_NAME = re.compile(r"\b([a-z][a-z0-9_]*)\b")


def with_ctes(select: str) -> str:
    """``WITH`` every CTE the statement uses (transitively), in definition order."""
    need: set[str] = set()
    todo = [select]
    while todo:
        for name in _NAME.findall(todo.pop()):
            if name in CTE and name not in need:
                need.add(name)
                todo.append(CTE[name])
    # materialised: several statements use the large facts more than once
    parts = [f"{n} AS MATERIALIZED ({CTE[n]}\n)" for n in CTE if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select


_SELECTS: dict[str, str] = {
    "csv_roundtrip_infer": "SELECT CAST(order_id AS INT) AS order_id, "
                           "CAST(customer_id AS INT) AS customer_id, "
                           "CAST(product_id AS INT) AS product_id, CAST(amount AS DOUBLE) AS amount, "
                           "currency, city, order_time, source FROM fx_orders",
    "bronze_orders_lineage": f"SELECT order_id, customer_id, product_id, amount, currency, city, "
                             f"order_time, TIMESTAMP '{AS_OF_TS}' AS ingested_at, "
                             f"'batch_csv' AS source FROM fx_orders",
    "clean_customers": "SELECT * FROM c_customers",
    "clean_products": "SELECT * FROM c_products",
    "clean_orders": "SELECT * FROM c_orders",
    "mask_pii_edge_cases": f"""
SELECT customer_id, variant, {_email_mask('email')} AS email, {_phone_mask('phone')} AS phone FROM (
  SELECT customer_id, 'as_is' AS variant, email, phone FROM fx_customers
  UNION ALL SELECT customer_id, 'no_at', replace(email, '@', ''), substr(phone, 1, 5) FROM fx_customers
  UNION ALL SELECT customer_id, 'at_first', substr(email, instr(email, '@')), phone || '12' FROM fx_customers
  UNION ALL SELECT customer_id, 'one_char', substr(email, 1, 1) || substr(email, instr(email, '@')), '' FROM fx_customers
  UNION ALL SELECT customer_id, 'empty', '', CAST(NULL AS VARCHAR) FROM fx_customers) v""",
    "dedup_latest_lineitem": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
        l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
        l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
      FROM lineitem) t WHERE rn = 1""",
    "orders_weather_join": """
SELECT o.order_id, o.customer_id, o.product_id, o.amount, o.currency, o.city, o.order_time,
  o.order_date, o.order_hour, o.source, w.temperature, w.weather_condition, w.wind_speed, w.humidity
FROM c_orders o LEFT JOIN fx_weather w ON o.city = w.city AND o.order_date = w.order_date
  AND o.order_hour = w.order_hour""",
    "weather_coverage": """
SELECT count(*) AS orders, count(temperature) AS with_weather,
  count(*) - count(temperature) AS without_weather FROM s_fact""",
    "orders_currency_join": """
SELECT order_id, customer_id, product_id, amount_inr, amount_usd, currency, city, order_time,
  order_date, order_hour, source, usd_exchange_rate FROM s_fact""",
    "fact_orders_silver": "SELECT * FROM s_fact",
    "dim_date": "SELECT * FROM g_dim_date",
    "dim_location": "SELECT * FROM g_dim_location",
    "dim_products_scd1": "SELECT * FROM g_dim_products",
    "fact_orders_gold": "SELECT * FROM g_fact",
    "fact_live_gold": "SELECT * FROM g_live",
    "revenue_by_category": """
SELECT p.category, CAST(round(sum(f.amount_inr) * 0.001, 2) AS DECIMAL(38,2)) AS revenue_inr_thousands,
  CAST(round(sum(f.amount_usd), 2) AS DECIMAL(38,2)) AS revenue_usd
FROM g_fact f JOIN g_dim_products p ON f.product_id = p.product_id GROUP BY p.category""",
    "orders_by_source": "SELECT source, count(*) AS orders FROM m_orders GROUP BY source",
    "buffer_by_date": "SELECT CAST(TRY_CAST(timestamp AS TIMESTAMP) AS DATE) AS date, count(*) AS orders "
                      "FROM fx_stream_orders GROUP BY 1",
    "last_dates": "SELECT strftime(order_time, '%Y-%m-%d') AS order_date, count(*) AS orders "
                  "FROM m_orders GROUP BY 1 ORDER BY 1 DESC NULLS LAST LIMIT 5",
    "live_totals": f"""
SELECT count(order_id) AS total_orders, {_money('sum(amount_inr)')} AS revenue_inr,
  {_money('sum(amount_usd)')} AS revenue_usd, {_avg_money('amount_inr')} AS avg_order_value_inr
FROM g_live""",
    "live_top_cities": f"""
SELECT city, count(order_id) AS orders, {_money('sum(amount_inr)')} AS revenue_inr FROM g_live
GROUP BY city ORDER BY revenue_inr DESC NULLS LAST, city NULLS FIRST LIMIT 5""",
    "live_by_category": f"SELECT category, count(order_id) AS orders, {_money('sum(amount_inr)')} "
                        f"AS revenue_inr FROM g_live GROUP BY category",
    "live_by_hour": "SELECT order_hour, count(order_id) AS orders FROM g_live GROUP BY order_hour",
    "live_by_weather": f"SELECT weather_condition, count(order_id) AS orders, "
                       f"{_money('sum(amount_inr)')} AS revenue_inr FROM g_live GROUP BY weather_condition",
    "top_cities_by_count": "SELECT city, count(*) AS orders FROM s_stream GROUP BY city "
                           "ORDER BY orders DESC, city NULLS FIRST LIMIT 5",
    "live_revenue": f"SELECT {_money('sum(amount_inr)')} AS total_inr, "
                    f"{_money('sum(amount_usd)')} AS total_usd FROM s_stream",
    "weather_distribution": "SELECT weather_condition, count(*) AS orders FROM s_stream "
                            "GROUP BY weather_condition",
    "merge_insert_only": "SELECT * FROM m_orders",
    "merge_audit": f"""
SELECT (SELECT count(*) FROM fx_orders) AS batch_before,
  (SELECT count(*) FROM a_stream) AS stream_rows,
  (SELECT count(*) FROM (SELECT order_id FROM a_stream INTERSECT SELECT order_id FROM fx_orders) i) AS duplicate_ids,
  (SELECT count(*) FROM (SELECT order_id FROM a_stream EXCEPT SELECT order_id FROM fx_orders) e) AS new_ids,
  (SELECT count(*) FROM m_orders) AS after,
  (SELECT count(*) FROM (
     SELECT order_id, sum(b) AS nb, sum(s) AS ns, min(pb) AS lo_b, max(pb) AS hi_b,
       min(ps) AS lo_s, max(ps) AS hi_s
     FROM (SELECT order_id, 1 AS b, 0 AS s, {_payload_sql()} AS pb, NULL AS ps FROM fx_orders
           UNION ALL
           SELECT order_id, 0, 1, NULL, {_payload_sql()} FROM a_stream) t
     GROUP BY order_id) g
   WHERE nb > 0 AND ns > 0 AND (lo_b <> lo_s OR hi_b <> hi_s)) AS payload_conflicts""",
    "upsert_products": "SELECT * FROM u_products",
    "upsert_idempotent": "SELECT * FROM u_products",
    "upsert_composite_key": f"""
SELECT * FROM (SELECT city, order_date, order_hour, temperature, weather_condition, wind_speed, humidity
  FROM fx_weather WHERE order_hour % 6 <> 0)
UNION ALL
SELECT city, order_date, order_hour, temperature + 0.5, weather_condition, wind_speed, humidity
FROM fx_weather WHERE order_hour % 6 = 0
UNION ALL
SELECT city, order_date, order_hour, temperature, weather_condition, wind_speed, humidity
FROM ({_fallback_hours('w_pairs')}) f""",
    "scd2_customers": "SELECT * FROM scd2_result",
    "scd2_counts": "SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current) AS current_rows, "
                   "count(*) FILTER (WHERE NOT is_current) AS historical_rows FROM scd2_result",
    "weather_gaps": "SELECT * FROM w_gaps",
    "weather_pairs": "SELECT * FROM w_pairs",
    "rate_gaps": "SELECT DISTINCT CAST(order_time AS DATE) AS rate_date FROM fx_orders "
                 "EXCEPT SELECT rate_date FROM usd",
    "hourly_flatten": "SELECT * FROM parsed_weather",
    "landed_weather_documents": "SELECT * FROM parsed_weather",
    "weather_filled": "SELECT * FROM weather_filled",
    "rate_filled": """
SELECT 'INR' AS base_currency, 'USD' AS target_currency, d.rate_date,
  COALESCE(u.exchange_rate, CAST(0.012 AS DECIMAL(10,6))) AS exchange_rate,
  u.exchange_rate IS NULL AS is_fallback
FROM (SELECT DISTINCT CAST(order_time AS DATE) AS rate_date FROM fx_orders) d
LEFT JOIN usd u ON d.rate_date = u.rate_date""",
    "geocode_first": """
SELECT n_name AS city, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) END AS latitude,
  CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(n_regionkey AS DOUBLE) END AS longitude FROM nation""",
    "enrich_run": "SELECT * FROM enrich_result",
    "layer_summary": """
SELECT 'bronze.orders' AS table_name, count(*) AS row_count FROM fx_orders
UNION ALL SELECT 'bronze.customers', count(*) FROM fx_customers
UNION ALL SELECT 'bronze.products', count(*) FROM fx_products
UNION ALL SELECT 'bronze.streaming_orders', count(*) FROM fx_stream_orders
UNION ALL SELECT 'silver.dim_customers', count(*) FROM c_customers
UNION ALL SELECT 'silver.dim_customers.unmasked_pii', count(*) FROM c_customers
  WHERE regexp_matches(email, '^[^*@]{2,}@') OR regexp_matches(phone, '^[0-9]{10}$')
UNION ALL SELECT 'silver.dim_products', count(*) FROM c_products
UNION ALL SELECT 'silver.fact_orders', count(*) FROM s_fact
UNION ALL SELECT 'silver.fact_streaming_orders', count(*) FROM s_stream
UNION ALL SELECT 'gold.dim_date', count(*) FROM g_dim_date
UNION ALL SELECT 'gold.dim_location', count(*) FROM g_dim_location
UNION ALL SELECT 'gold.fact_orders', count(*) FROM g_fact""",
    "lakehouse_end_to_end": """
SELECT p.category, CAST(round(sum(o.amount) * 0.001, 2) AS DECIMAL(38,2)) AS revenue_inr_thousands,
  CAST(round(sum(CAST(round(o.amount * COALESCE(r.exchange_rate, CAST(0.012 AS DECIMAL(10,6))), 2)
                      AS DECIMAL(18,2))), 2) AS DECIMAL(38,2)) AS revenue_usd
FROM c_orders o JOIN c_products p ON o.product_id = p.product_id
LEFT JOIN usd r ON o.order_date = r.rate_date
GROUP BY p.category""",
    "live_kpi_refresh": f"""
SELECT 'totals' AS kpi, CAST(NULL AS VARCHAR) AS key, count(order_id) AS orders,
  {_money('sum(amount_inr)')} AS revenue_inr, {_money('sum(amount_usd)')} AS revenue_usd,
  {_avg_money('amount_inr')} AS avg_order_value_inr FROM g_live
UNION ALL SELECT * FROM (SELECT 'top_cities', city, count(order_id), {_money('sum(amount_inr)')} AS r,
  {_money('sum(amount_usd)')}, {_avg_money('amount_inr')}
  FROM g_live GROUP BY city ORDER BY r DESC NULLS LAST, city NULLS FIRST LIMIT 5)
UNION ALL SELECT 'by_category', category, count(order_id), {_money('sum(amount_inr)')},
  {_money('sum(amount_usd)')}, {_avg_money('amount_inr')} FROM g_live GROUP BY category
UNION ALL SELECT 'by_hour', CAST(order_hour AS VARCHAR), count(order_id), {_money('sum(amount_inr)')},
  {_money('sum(amount_usd)')}, {_avg_money('amount_inr')} FROM g_live GROUP BY order_hour
UNION ALL SELECT 'by_weather', weather_condition, count(order_id), {_money('sum(amount_inr)')},
  {_money('sum(amount_usd)')}, {_avg_money('amount_inr')} FROM g_live GROUP BY weather_condition""",
    "csv_rejects": """
SELECT concat_ws(',', order_id, customer_id, product_id,
    CASE WHEN order_id % 50 = 0 THEN 'none' ELSE CAST(amount AS VARCHAR) END,
    CASE WHEN order_id % 50 <> 2 THEN concat_ws(',', currency, city,
      strftime(order_time, '%Y-%m-%d %H:%M:%S'), CASE WHEN order_id % 50 = 1 THEN 'more' END) END)
    AS line, CAST(1 AS BIGINT) AS n, CAST(NULL AS DECIMAL(38,2)) AS amount
FROM fx_orders WHERE order_id % 50 IN (0, 1, 2)
UNION ALL SELECT 'rows that fit', count(*), CAST(sum(amount) AS DECIMAL(38,2))
FROM fx_orders WHERE order_id % 50 NOT IN (0, 1, 2)""",
    "truncate_keeps_schema": """
SELECT 'loaded' AS step, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS amount,
  CAST(8 AS BIGINT) AS n_columns FROM fx_orders
UNION ALL SELECT 'emptied', CAST(0 AS BIGINT), NULL, 8
UNION ALL SELECT 'loaded again', count(*), CAST(sum(amount) AS DECIMAL(38,2)), 8 FROM a_stream""",
    "scd2_stored_history": "SELECT * FROM scd2_result",
    "orders_landed_again": """
SELECT order_id, CASE WHEN order_id % 3 = 0 THEN CAST(amount + 1 AS DECIMAL(18,2)) ELSE amount END AS amount,
  CASE WHEN order_id % 3 = 0 THEN order_time + INTERVAL 40 DAY ELSE order_time END AS order_time,
  source, CAST(NULL AS INT) AS message_partition,
  strftime(CASE WHEN order_id % 3 = 0 THEN order_time + INTERVAL 40 DAY ELSE order_time END, '%Y-%m')
    AS order_month
FROM fx_orders
UNION ALL
SELECT order_id, amount, TRY_CAST(timestamp AS TIMESTAMP), 'streaming', message_partition,
  strftime(TRY_CAST(timestamp AS TIMESTAMP), '%Y-%m')
FROM q_stream s WHERE NOT EXISTS (SELECT 1 FROM fx_orders b WHERE b.order_id = s.order_id)""",
    "live_totals_on_day": f"""
SELECT count(order_id) AS total_orders, {_money('sum(amount_inr)')} AS revenue_inr,
  {_money('sum(amount_usd)')} AS revenue_usd, {_avg_money('amount_inr')} AS avg_order_value_inr
FROM g_live WHERE order_date = DATE '{KPI_DAY}'""",
    "layer_samples": """
SELECT * FROM (SELECT 'silver.dim_customers' AS table_name, customer_id AS id, name AS label
  FROM c_customers ORDER BY customer_id LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'silver.dim_products', product_id, product_name
  FROM c_products ORDER BY product_id LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'silver.fact_orders', order_id, city
  FROM s_fact ORDER BY order_id LIMIT 5)""",
    "number_lineitems": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                     l_shipdate) AS line_id
FROM lineitem""",
    "dedup_incomplete_customers": with_gaps_sql(),
    "merge_into_existing": """
SELECT order_id, amount, strftime(order_time, '%Y-%m') AS order_month FROM fx_orders
WHERE order_id % 3 <> 0
UNION ALL SELECT order_id, CAST(amount + 1 AS DECIMAL(18,2)), CASE WHEN order_id % 5 <> 0
  THEN strftime(order_time + INTERVAL 31 DAY, '%Y-%m') END
FROM fx_orders WHERE order_id % 3 = 0
UNION ALL SELECT -order_id - 1, amount, CASE WHEN order_id % 2 = 0 THEN '1900-01' END
FROM fx_orders WHERE order_id % 7 = 0""",
    # streaming queries: their batch equivalents
    "stream_upsert_batches": """
SELECT order_id, customer_id, product_id, amount, currency, city, order_time, source
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_time DESC) AS rn
      FROM (SELECT * FROM a_stream
            UNION ALL SELECT order_id, customer_id, product_id, amount + 5, currency, city,
              order_time + INTERVAL 40 DAY, source FROM a_stream WHERE order_id % 6 = 0
            UNION ALL SELECT order_id, customer_id, product_id, amount + 9, currency, city,
              order_time - INTERVAL 40 DAY, source FROM a_stream WHERE order_id % 10 = 0) u) r
WHERE rn = 1""",
    "stream_rejects": "SELECT 'broken ' || order_id AS body, 'no order id' AS reason, "
                      "message_partition, message_offset FROM q_stream WHERE order_id % 50 = 0",
    "lake_stream_end_to_end": f"""
SELECT count(order_id) AS total_orders, {_money('sum(amount)')} AS revenue_inr,
  {_money('sum(usd)')} AS revenue_usd, {_avg_money('amount')} AS avg_order_value_inr
FROM (SELECT o.*, CAST(round(o.amount * COALESCE(r.exchange_rate, CAST(0.012 AS DECIMAL(10,6))), 2)
                       AS DECIMAL(18,2)) AS usd
      FROM c_stream o LEFT JOIN usd r ON o.order_date = r.rate_date) t""",
    "stream_parse_append": "SELECT * FROM q_stream",
    "stream_restart_exactly_once": "SELECT * FROM q_stream",
    "stream_processing_time": "SELECT * FROM q_stream",
    "stream_first_message_wins": """
SELECT c.cut, t.* FROM (VALUES ('one'), ('many')) AS c(cut), (
  SELECT order_id, customer_id, amount, city, order_time, source,
    CAST(NULL AS TIMESTAMP) AS enqueued_at, CAST(NULL AS INT) AS message_partition
  FROM fx_orders WHERE order_id % 8 = 0
  UNION ALL
  SELECT order_id, customer_id, amount, city, TRY_CAST(timestamp AS TIMESTAMP), 'streaming',
    enqueued_at, message_partition
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY enqueued_at) AS rn
        FROM (SELECT * FROM q_stream
              UNION ALL SELECT order_id, customer_id, product_id, amount + 5, currency, city,
                timestamp, enqueued_at + INTERVAL 30 MINUTE, 9, message_offset
              FROM q_stream WHERE order_id % 6 = 0
              UNION ALL SELECT order_id, customer_id, product_id, amount + 9, currency, city,
                timestamp, enqueued_at - INTERVAL 30 MINUTE, 9, message_offset
              FROM q_stream WHERE order_id % 10 = 0) u) r
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM fx_orders b
    WHERE b.order_id = r.order_id AND b.order_id % 8 = 0)) t""",
    "stream_enrich_upsert": "SELECT * FROM s_stream",
    "stream_live_fact": "SELECT * FROM g_live",
    "stream_live_by_hour": "SELECT order_hour, count(*) AS orders FROM c_stream GROUP BY order_hour",
    "stream_merge_then_drain": """
SELECT (SELECT count(*) FROM fx_orders) AS batch_before,
  (SELECT count(*) FROM fx_stream_orders) AS buffered,
  (SELECT count(*) FROM m_orders) - (SELECT count(*) FROM fx_orders) AS added,
  (SELECT count(*) FROM m_orders) AS after,
  CAST(0 AS BIGINT) AS buffer_after""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sel) for name, sel in _SELECTS.items()}
