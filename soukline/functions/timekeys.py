"""Time keys, lineage and currency conversion as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MONEY, TS_FORMAT


def ts_lit(value) -> Column:
    """A timestamp literal; ``None`` means the query's current timestamp."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, str):
        return F.to_timestamp(F.lit(value))
    return F.lit(value).cast("timestamp")


def date_lit(value) -> Column:
    """A date literal; ``None`` means the query's current date."""
    if value is None:
        return F.current_date()
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat()[:10]
    return F.to_date(F.lit(value))


def parse_ts(c: Column | str) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` or a timestamp -> TIMESTAMP; bad text -> NULL."""
    s = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.try_to_timestamp(s.cast("string"), F.lit(TS_FORMAT)),
                      F.try_to_timestamp(s.cast("string")))


def with_lineage(df: DataFrame, source: str, as_of=None) -> DataFrame:
    """Add ``ingested_at`` and ``source`` (``as_of`` pins the clock for replays)."""
    return df.withColumns({"ingested_at": ts_lit(as_of), "source": F.lit(source)})


def with_time_keys(df: DataFrame, ts_col: str = "order_time") -> DataFrame:
    """``order_date`` (DATE) and ``order_hour`` (0-23) from an order timestamp."""
    ts = F.col(ts_col)
    return df.withColumns({"order_date": F.to_date(ts), "order_hour": F.hour(ts)})


def to_usd(amount: Column | str, rate: Column | str) -> Column:
    """``round(amount * rate, 2)`` in decimal; a missing rate gives NULL."""
    a = F.col(amount) if isinstance(amount, str) else amount
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.round(a * r, 2).cast(MONEY)
