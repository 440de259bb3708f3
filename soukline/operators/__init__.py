from .clean import (align_stream_orders, clean_customers, clean_orders, clean_products,
                    clean_stream_orders, normalize_text, stream_order_rejects)
from .enrich import (enrich_orders, enrich_rates, enrich_weather, fill_rates, fill_weather,
                     flatten_hourly, gap_pairs, geocode_first, hours_by_pair, join_rate,
                     join_weather, missing_hours, rate_gaps, weather_coverage, weather_description, weather_gaps)
from .keys import dedup_by_key, unique_or_error, with_sequential_id
from .merge import (insert_first, insert_only, replace_keys, scd2, scd2_changes,
                    scd2_versions, upsert, upsert_latest)
from .star import dim_date, dim_location, dim_products, fact_live, fact_orders_gold

__all__ = [n for n in dir() if not n.startswith("_")]
