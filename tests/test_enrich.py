import json

from soukline.operators import (fill_rates, fill_weather, flatten_hourly, geocode_first,
                                weather_description)


def _doc(n=24, hole=None, code=0):
    arr = lambda v: [None if hole == i else v for i in range(n)]
    return json.dumps({"hourly": {"temperature_2m": arr(20.5), "weathercode": arr(code),
                                  "windspeed_10m": arr(3.0), "relativehumidity_2m": arr(60)}})


def test_flatten_good_and_bad_documents(spark):
    docs = spark.createDataFrame([
        ("Pune", "2024-01-05", _doc()),                # usable
        ("Agra", "2024-01-05", _doc(hole=5)),          # NULL element -> fallback
        ("Goa", "2024-01-05", _doc(n=23)),             # short array -> fallback
        ("Kochi", "2024-01-05", "not json"),           # bad JSON -> fallback
        ("Delhi", "2024-01-05", _doc(n=30, code=95)),  # longer array: first 24 used
    ], "city string, order_date string, payload string")
    out = flatten_hourly(docs)
    per_city = {r.city: r for r in out.groupBy("city").agg(
        {"order_hour": "count", "is_fallback": "max", "temperature": "sum"})
        .withColumnsRenamed({"count(order_hour)": "n", "max(is_fallback)": "fb",
                             "sum(temperature)": "t"}).collect()}
    assert {c: r.n for c, r in per_city.items()} == {c: 24 for c in per_city}
    assert per_city["Pune"].fb is False and per_city["Pune"].t == 24 * 20.5
    for c in ("Agra", "Goa", "Kochi"):
        assert per_city[c].fb is True and per_city[c].t == 0.0
    d = out.filter("city = 'Delhi'").select("weather_condition").distinct().collect()
    assert [r[0] for r in d] == ["Thunderstorm"]
    hours = sorted(r.order_hour for r in out.filter("city = 'Pune'").collect())
    assert hours == list(range(24))


def test_fill_weather_missing_document(spark):
    pairs = spark.createDataFrame([("Pune", "2024-01-05"), ("Goa", "2024-01-06")],
                                  "city string, order_date string")
    docs = spark.createDataFrame([("Pune", "2024-01-05", _doc())],
                                 "city string, order_date string, payload string")
    out = fill_weather(pairs, docs)
    fb = out.filter("city = 'Goa'").collect()
    assert len(fb) == 24
    assert {(r.temperature, r.weather_condition, r.wind_speed, r.humidity, r.is_fallback)
            for r in fb} == {(0.0, "Unknown", 0.0, 0, True)}


def test_fill_rates(spark):
    dates = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)],
                                  "rate_date string")
    docs = spark.createDataFrame([("2024-01-01", '{"rates":{"USD":0.0121}}'),
                                  ("2024-01-02", '{"rates":{"EUR":0.011}}')],
                                 "rate_date string, payload string")
    got = {r.rate_date: (str(r.exchange_rate), r.is_fallback)
           for r in fill_rates(dates, docs).collect()}
    assert got == {"2024-01-01": ("0.012100", False), "2024-01-02": ("0.012000", True),
                   "2024-01-03": ("0.012000", True)}


def test_geocode_first_and_codes(spark):
    docs = spark.createDataFrame(
        [("Pune", '{"results":[{"latitude":18.5,"longitude":73.8},{"latitude":0,"longitude":0}]}'),
         ("Nowhere", "{}")], "city string, payload string")
    got = {r.city: (r.latitude, r.longitude) for r in geocode_first(docs).collect()}
    assert got == {"Pune": (18.5, 73.8), "Nowhere": (None, None)}
    codes = spark.createDataFrame([(0,), (99,), (7,), (None,)], "c int")
    out = [r[0] for r in codes.select(weather_description("c")).collect()]
    assert out == ["Clear Sky", "Thunderstorm with Hail", "Unknown", "Unknown"]


def test_coverage_masks_find_the_same_gaps(spark):
    import datetime as dt
    from soukline.operators import hours_by_pair, missing_hours, weather_gaps
    day = dt.datetime(2024, 1, 5)
    orders = spark.createDataFrame(
        [("Pune", day + dt.timedelta(hours=h)) for h in (0, 0, 5, 23, 24)]
        + [("Goa", day), (None, day), ("Agra", None)], "city string, order_time timestamp")
    stored = spark.createDataFrame(
        [("Pune", day.date(), h) for h in (0, 5, 7)], "city string, order_date date, order_hour int")
    want = {("Pune", day.date(), 23), ("Pune", day.date() + dt.timedelta(days=1), 0),
            ("Goa", day.date(), 0)}
    masks = hours_by_pair(stored)
    assert masks.first().hours == 1 << 0 | 1 << 5 | 1 << 7
    for got in (weather_gaps(orders, stored), weather_gaps(orders, coverage=masks)):
        assert set(map(tuple, got.collect())) == want
    assert missing_hours(orders, None).count() == 3
