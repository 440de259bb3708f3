import pytest
from pyspark.sql import functions as F

from soukline.functions import mask_all_pii


@pytest.mark.parametrize("email,expected", [
    ("m.keller@post.example", "m*******@post.example"),   # documented example
    ("a@x", "a@x"),
    ("ab@x.com", "a*@x.com"),
    ("@x.com", "******"),          # no local part: star it all (no '@@x.com')
    ("noat", "****"),              # no '@': never leak the value
    ("", ""),
    (None, None),
])
def test_email_mask(spark, email, expected):
    df = spark.createDataFrame([(email, "5550104477")], "email string, phone string")
    assert mask_all_pii(df).first()["email"] == expected


@pytest.mark.parametrize("phone,expected", [
    ("5550104477", "******4477"),   # documented example
    ("98765", "******"),
    ("915550104477", "******1044"),  # characters 7..10, as the original contract
    (None, None),
])
def test_phone_mask(spark, phone, expected):
    df = spark.createDataFrame([("a@b.c", phone)], "email string, phone string")
    assert mask_all_pii(df).first()["phone"] == expected


def test_phone_mask_numeric_input(spark):
    df = spark.range(1).select(F.lit(5550104477).alias("phone"), F.lit("x@y").alias("email"))
    assert mask_all_pii(df).first()["phone"] == "******4477"


def test_name_is_kept(spark):
    df = spark.createDataFrame([("Mara Keller", "mara@post.example", "5550104477")],
                               "name string, email string, phone string")
    row = mask_all_pii(df).first()
    assert row["name"] == "Mara Keller"
    assert row["email"] == "m***@post.example"
    assert row["phone"] == "******4477"


def test_phone_mask_last4_option(spark):
    from soukline.functions import phone_mask
    df = spark.createDataFrame([("915550104477",), ("5550104477",), (None,)], "phone string")
    got = [r[0] for r in df.select(phone_mask("phone", last4=True)).collect()]
    assert got == ["******4477", "******4477", None]
