"""Column expressions: prices, calendar parts, safe ratios, local time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_change(now: str | Column, before: str | Column) -> Column:
    """(now - before) / before, null where ``before`` is zero or null."""
    now = F.col(now) if isinstance(now, str) else now
    before = F.col(before) if isinstance(before, str) else before
    return F.try_divide(now - before, before)


def price_columns() -> dict[str, Column]:
    """The four prices derived from one bar."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return {
        "price_change": F.round(c - o, 4),
        "price_change_pct": F.round(ratio_change(c, o) * 100, 4),
        "range": F.round(h - lo, 4),
        "avg_price": F.round((o + h + lo + c) / 4, 4),
    }


def calendar_columns(at: str = "datetime") -> dict[str, Column]:
    """Calendar parts; ``day`` is the day of the month, ``day_of_week`` is 1 = Sunday … 7 = Saturday."""
    return {
        "year": F.year(at),
        "month": F.month(at),
        "day": F.dayofmonth(at),
        "hour": F.hour(at),
        "day_of_week": F.dayofweek(at),
    }


def known_volume(volume: str = "volume") -> Column:
    """Volume with the 'missing' marker 0 turned into null."""
    return F.nullif(F.col(volume), F.lit(0))


def to_local(at: str, zone: str) -> Column:
    return F.from_utc_timestamp(F.col(at), zone)


def order_key(ts: str, tie: str) -> Column:
    """One number that sorts like (ts, tie) for a timestamp and a bigint.

    Fixed width, so min_by/max_by over it stay in a hash aggregate, which a struct key would not.
    The factor exceeds the width of a bigint, so ties never cross over to another instant.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("decimal(18,0)")
    factor = F.lit("20000000000000000000").cast("decimal(20,0)")
    return micros * factor + F.col(tie).cast("decimal(19,0)")


def present(name: str, is_double: bool) -> Column:
    """Neither null nor NaN."""
    c = F.col(name)
    return c.isNotNull() & ~F.isnan(c) if is_double else c.isNotNull()
