import datetime as dt

from soukline.operators import dim_date, dim_location


def test_dim_date_attributes(spark):
    orders = spark.createDataFrame([(dt.date(2020, 12, 30),), (dt.date(2021, 1, 3),)],
                                   "order_date date")
    rows = {r.full_date: r for r in dim_date(orders).collect()}
    assert len(rows) == 5
    r = rows[dt.date(2021, 1, 1)]
    assert (r.date_id, r.date_str, r.year, r.quarter, r.month, r.month_name) == \
        (20210101, "2021-01-01", 2021, 1, 1, "January")
    assert r.week_of_year == 53            # ISO week of 2021-01-01
    assert (r.day_of_week, r.day_name, r.is_weekend) == (6, "Friday", False)
    sun = rows[dt.date(2021, 1, 3)]
    assert (sun.day_of_week, sun.is_weekend) == (1, True)
    assert rows[dt.date(2020, 12, 30)].is_festive_season is True
    assert r.is_festive_season is False


def test_dim_date_empty_input(spark):
    empty = spark.createDataFrame([], "order_date date")
    assert dim_date(empty).count() == 0


def test_dim_location_keeps_existing_ids(spark):
    orders = spark.createDataFrame([("Pune",), ("Agra",), ("Pune",)], "city string")
    first = dim_location(orders)
    assert sorted((r.location_id, r.city, r.country) for r in first.collect()) == \
        [(1, "Agra", "India"), (2, "Pune", "India")]
    more = spark.createDataFrame([("Goa",), ("Agra",), ("Bhopal",)], "city string")
    second = {r.city: r.location_id for r in dim_location(more, existing=first).collect()}
    assert second == {"Agra": 1, "Pune": 2, "Bhopal": 3, "Goa": 4}


def test_live_kpis_today_view(spark):
    import decimal
    from soukline.plans import reports as rp
    live = spark.createDataFrame(
        [(1, dt.date(2024, 1, 5), "Pune", decimal.Decimal("10.00"), decimal.Decimal("0.12")),
         (2, dt.date(2024, 1, 6), "Goa", decimal.Decimal("30.00"), decimal.Decimal("0.36"))],
        "order_id int, order_date date, city string, amount_inr decimal(18,2), "
        "amount_usd decimal(18,2)")
    assert rp.live_totals(live).first().total_orders == 2
    today = rp.live_totals(live, as_of="2024-01-06").first()
    assert (today.total_orders, str(today.revenue_inr)) == (1, "30.00")
    assert [r.city for r in rp.live_top_cities(live, as_of="2024-01-05").collect()] == ["Pune"]
