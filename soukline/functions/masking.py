"""PII masks as JVM-side Column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PHONE_MASK, PHONE_VISIBLE_FROM, PHONE_VISIBLE_LEN


def phone_mask(c: Column | str, last4: bool = False) -> Column:
    """``'******' + characters 7..10`` of the number (``5550104477 -> ******4477``).

    Shorter numbers show what exists in that window (a 5-digit number gives
    ``******``); NULL stays NULL. ``last4=True`` shows the last four characters
    instead, which is what the rule intends for numbers that are not 10 digits long
    (a 12-digit number then ends in its real last four).
    """
    s = (F.col(c) if isinstance(c, str) else c).cast("string")
    visible = (F.substring(s, -PHONE_VISIBLE_LEN, PHONE_VISIBLE_LEN) if last4
               else F.substring(s, PHONE_VISIBLE_FROM, PHONE_VISIBLE_LEN))
    return F.concat(F.lit(PHONE_MASK), visible)


def email_mask(c: Column | str) -> Column:
    """First character, one ``*`` per hidden character, then everything from ``@``.

    ``m.keller@post.example -> m*******@post.example``. A value with no ``@`` or
    with ``@`` first has no domain to keep and is starred over its whole length, so
    the local part never leaks. NULL stays NULL.
    """
    s = F.col(c) if isinstance(c, str) else c
    at = F.locate("@", s)
    masked = F.concat(F.substring(s, 1, 1), F.repeat(F.lit("*"), at - 2),
                      F.substring(s, at, F.length(s)))
    return F.when(at > 1, masked).otherwise(F.repeat(F.lit("*"), F.length(s)))


def mask_phone(df: DataFrame, column: str = "phone") -> DataFrame:
    return df.withColumn(column, phone_mask(column))


def mask_email(df: DataFrame, column: str = "email") -> DataFrame:
    return df.withColumn(column, email_mask(column))


def mask_all_pii(df: DataFrame, phone: str = "phone", email: str = "email") -> DataFrame:
    """Phone then email masked in one projection; names are kept."""
    return df.withColumns({phone: phone_mask(phone), email: email_mask(email)})
