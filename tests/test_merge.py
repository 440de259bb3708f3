import datetime as dt

import pytest

from soukline.operators import insert_only, scd2, upsert, upsert_latest

SCHEMA = "k int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, v if v is not None else 0) if not isinstance(v, str) else (v is None, v) for v in r))


def test_upsert_matched_unmatched_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n0")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "n1")], SCHEMA)
    out = set(tuple(r) for r in upsert(t, s, ["k"]).collect())
    # NULL keys never match: both NULL-key rows survive
    assert out == {(1, "a"), (2, "B"), (3, "C"), (None, "n0"), (None, "n1")}


def test_upsert_empty_target_and_idempotent(spark):
    s = spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA)
    assert rows(upsert(None, s, ["k"])) == [(1, "x"), (2, "y")]
    t = spark.createDataFrame([(1, "a"), (5, "e")], SCHEMA)
    once = upsert(t, s, ["k"])
    assert rows(upsert(once, s, ["k"])) == rows(once)


def test_upsert_rejects_different_columns(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(1, "a", 2)], "k int, v string, w int")
    with pytest.raises(ValueError):
        upsert(t, s, ["k"])


def test_duplicate_source_keys_raise(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    target = spark.createDataFrame([(1, "z")], SCHEMA)
    with pytest.raises(Exception, match="more than one source row"):
        upsert(target, twice, ["k"]).collect()


def test_upsert_latest_does_not_depend_on_batches(spark):
    rows = [(1, "a"), (1, "c"), (2, "x"), (1, "b"), (2, "w")]
    one = upsert_latest(None, spark.createDataFrame(rows, SCHEMA), ["k"])
    many = None
    for r in rows:
        many = upsert_latest(many, spark.createDataFrame([r], SCHEMA), ["k"])
    assert sorted(one.collect()) == sorted(many.collect()) == [(1, "c"), (2, "x")]


def test_insert_only(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c2")], SCHEMA)
    # default: repeated new keys arrive once (deterministic survivor), existing kept
    assert rows(insert_only(t, s, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    # plain merge semantics: every copy of a new key is inserted
    assert len(rows(insert_only(t, s, ["k"], dedup_source=False))) == 4


CUST = "customer_id int, name string, city string"
D0, D1, D2 = "2024-01-01", "2024-02-01", "2024-03-01"


def test_scd2_cases(spark):
    first = scd2(None, spark.createDataFrame(
        [(1, "A", "Pune"), (2, "B", "Delhi"), (3, "C", None), (4, "D", "Goa")], CUST), as_of=D0)
    nxt = spark.createDataFrame(
        [(1, "A", "Pune"),        # unchanged
         (2, "B", "Mumbai"),      # moved -> new version
         (3, "C", "Agra"),        # NULL city before: not a change
         (5, "E", "Kochi"),       # new
         (4, "Dx", "Goa")],       # name only: no version, no update
        CUST)
    out = scd2(first, nxt, as_of=D1)
    got = {(r.customer_id, r.city, str(r.start_date), str(r.end_date), r.is_current)
           for r in out.collect()}
    assert got == {
        (1, "Pune", D0, "None", True),
        (2, "Delhi", D0, D1, False), (2, "Mumbai", D1, "None", True),
        (3, None, D0, "None", True),
        (4, "Goa", D0, "None", True),
        (5, "Kochi", D1, "None", True),
    }
    names = {r.customer_id: r.name for r in out.filter("is_current").collect()}
    assert names[4] == "D"
    # one current row per customer
    assert out.filter("is_current").groupBy("customer_id").count().filter("count > 1").isEmpty()
    # rerun with the same snapshot the same day is a no-op
    assert sorted(map(tuple, scd2(out, nxt, as_of=D1).collect()), key=str) == \
        sorted(map(tuple, out.collect()), key=str)
    # change back creates a third version; history untouched
    back = spark.createDataFrame([(2, "B", "Delhi")], CUST)
    out3 = scd2(out, back, as_of=D2)
    v2 = sorted((str(r.start_date), str(r.end_date), r.city, r.is_current)
                for r in out3.filter("customer_id = 2").collect())
    assert v2 == [(D0, D1, "Delhi", False), (D1, D2, "Mumbai", False), (D2, "None", "Delhi", True)]


def test_scd2_null_incoming_city_is_not_a_change(spark):
    first = scd2(None, spark.createDataFrame([(1, "A", "Pune")], CUST), as_of=D0)
    out = scd2(first, spark.createDataFrame([(1, "A", None)], CUST), as_of=D1)
    assert [(r.city, r.is_current) for r in out.collect()] == [("Pune", True)]
    assert out.first().start_date == dt.date(2024, 1, 1)


def test_scd2_tracks_several_attributes(spark):
    schema = "customer_id int, city string, email string"
    first = scd2(None, spark.createDataFrame([(1, "Pune", "a@x"), (2, "Goa", "b@x")], schema),
                 as_of=D0)
    nxt = spark.createDataFrame([(1, "Pune", "a2@x"), (2, "Goa", "b@x")], schema)
    city_only = scd2(first, nxt, as_of=D1)
    assert city_only.count() == 2                       # email change ignored by default
    both = scd2(first, nxt, as_of=D1, tracked=("city", "email"))
    got = sorted((r.customer_id, r.email, r.is_current) for r in both.collect())
    assert got == [(1, "a2@x", True), (1, "a@x", False), (2, "b@x", True)]


def test_source_is_planned_once(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(1, "a", "Pune")], CUST).write.parquet(path)
    src = spark.read.parquet(path).filter("name <> 'x'")
    target = spark.createDataFrame([(1, "b", "Goa")], CUST)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count(
        "FileScan parquet")
    assert scans(upsert(target, src, ["customer_id"])) == 1
    assert scans(upsert(None, src, ["customer_id"])) == 1
    assert scans(scd2(None, src, as_of=D0)) == 1
    assert scans(scd2(scd2(None, target, as_of=D0), src, as_of=D1)) == 1


def test_rows_without_key_are_spread(spark):
    """Rows that match nothing must not meet in one task because their key is NULL."""
    n = 20_000
    src = spark.range(n).selectExpr("CAST(NULL AS INT) AS k", "CAST(id AS STRING) AS v")
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    out = upsert(target, src, ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[1] for r in out.selectExpr("spark_partition_id() AS p").groupBy("p").count()
                 .collect()]
        assert sum(sizes) == n + 1 and max(sizes) < n / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_replace_keys_keeps_copies_of_a_delivery(spark):
    from soukline.operators import replace_keys
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], SCHEMA)
    s = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "m")], SCHEMA)
    assert set(map(tuple, replace_keys(t, s, ["k"]).collect())) == {
        (1, "x"), (1, "y"), (2, "c"), (3, "z"), (None, "n"), (None, "m")}
