"""Calendar attributes of a DATE column (the columns of the date dimension)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FESTIVE_MONTHS, WEEKEND_DAYS


def date_attributes(d: Column | str) -> list[Column]:
    """13 attributes: key ``yyyyMMdd`` int, ISO week, 1=Sunday day of week, flags."""
    c = F.col(d) if isinstance(d, str) else d
    dow = F.dayofweek(c)
    return [
        F.date_format(c, "yyyyMMdd").cast("int").alias("date_id"),
        c.alias("full_date"),
        F.date_format(c, "yyyy-MM-dd").alias("date_str"),
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.weekofyear(c).alias("week_of_year"),
        F.dayofmonth(c).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_name"),
        dow.isin(list(WEEKEND_DAYS)).alias("is_weekend"),
        F.month(c).isin(list(FESTIVE_MONTHS)).alias("is_festive_season"),
    ]
