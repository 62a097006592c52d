"""Receipt-time columns, the trading session and trading-date checks.

The session time zone must be UTC (see ``session.prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market zone and session bounds (the close is exclusive).
MARKET_ZONE = "Asia/Kolkata"
SESSION_OPEN = "09:15:00"
SESSION_CLOSE = "15:31:00"


def utc_time(unix_ns: Column) -> Column:
    """Nanoseconds since the epoch as a timestamp, truncated to microseconds."""
    return F.timestamp_micros(F.call_function("div", unix_ns, F.lit(1000)))


def local_time(utc: Column, zone: str = MARKET_ZONE) -> Column:
    """Wall clock of the zone, carried in a timestamp that renders as that clock."""
    return F.from_utc_timestamp(utc, zone)


def zone_offset(utc: Column, local: Column) -> Column:
    """``+hh:mm`` between a UTC time and its wall clock."""
    minutes = F.call_function(
        "div", F.unix_micros(local) - F.unix_micros(utc), F.lit(60_000_000)
    )
    size = F.abs(minutes)
    return F.concat(
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(F.call_function("div", size, F.lit(60)).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def iso_local(utc: Column, zone: str = MARKET_ZONE) -> Column:
    local = local_time(utc, zone)
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), zone_offset(utc, local)
    )


def trading_date(utc: Column, zone: str = MARKET_ZONE) -> Column:
    return F.date_format(local_time(utc, zone), "yyyy-MM-dd")


def receipt_hour(utc: Column, zone: str = MARKET_ZONE) -> Column:
    return F.date_format(local_time(utc, zone), "HH")


def in_session(utc: Column) -> Column:
    """Monday to Friday, from the open up to but excluding the close, in the market zone."""
    local = local_time(utc, MARKET_ZONE)
    clock = F.date_format(local, "HH:mm:ss")
    return (F.weekday(local) < 5) & (clock >= SESSION_OPEN) & (clock < SESSION_CLOSE)


def is_compact_date(text: Column) -> Column:
    """Eight digits."""
    return F.coalesce(text.rlike("^[0-9]{8}$"), F.lit(False))


def is_calendar_date(text: Column) -> Column:
    """Eight digits that name a real day."""
    return is_compact_date(text) & F.try_to_timestamp(text, F.lit("yyyyMMdd")).isNotNull()
