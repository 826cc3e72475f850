"""Calendar and time helpers (all JVM expressions, session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardrisk.schema import TX_DATETIME, TX_DURING_NIGHT, TX_DURING_WEEKEND


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_weekend(ts) -> Column:
    """1 on Saturday and Sunday (weekday() counts Monday as 0)."""
    return (F.weekday(_c(ts)) >= 5).cast("int")


def is_night(ts) -> Column:
    """1 from 00:00 to 06:59."""
    return (F.hour(_c(ts)) <= 6).cast("int")


def add_calendar_flags(df: DataFrame, ts: str = TX_DATETIME) -> DataFrame:
    return df.withColumns({TX_DURING_WEEKEND: is_weekend(ts), TX_DURING_NIGHT: is_night(ts)})


def parse_timestamp(x, fmt: str | None = None, lenient: bool = False) -> Column:
    """Strict parse raises on bad input (ANSI); lenient parse gives NULL."""
    c = _c(x)
    if lenient:
        return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)


def tx_date(ts=TX_DATETIME) -> Column:
    return F.to_date(_c(ts))


def hour_of(ts=TX_DATETIME) -> Column:
    return F.hour(_c(ts))


def day_name(ts=TX_DATETIME) -> Column:
    """Full English weekday name, e.g. 'Monday'."""
    return F.date_format(_c(ts), "EEEE")


def clock_hhmm(ts=TX_DATETIME) -> Column:
    return F.date_format(_c(ts), "HH:mm")


def iso_day(ts=TX_DATETIME) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")
