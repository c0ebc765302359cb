"""Ticks to open/high/low/close/volume bars, at once or in parts that merge."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.functions.expr import order_key


def _size(ticks: DataFrame) -> Column:
    return F.col("size").cast("long") if "size" in ticks.columns else F.lit(1).cast("long")


def bar_aggregates(ticks: DataFrame) -> list[Column]:
    """First, highest, lowest and last price, and the summed size of ticks; without a ``size`` each counts 1.

    All buffers are fixed width: the ticks of a hot symbol or hour are combined by hash on the map side
    and only one row per (symbol, interval) and task is shuffled. For one aggregate, as a stream needs it.
    """
    traded = F.col("price").isNotNull()  # a tick without price is no trade
    at = F.when(traded, order_key("ts", "tick_id"))
    return [
        F.min_by("price", at).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", at).alias("close"),
        F.coalesce(F.sum(F.when(traded, _size(ticks))), F.lit(0).cast("long")).alias("volume"),
    ]


def partial_bars(ticks: DataFrame, interval: str = "1 hour") -> DataFrame:
    """What ticks add to bars: a bar's columns, and time and id of the ticks that its open and close come from.

    Ticks are ordered by one long made of the microseconds since the start of the bar and the low bits of the id;
    the high bits are part of the key, so the order is exact whatever the ids. A bar is in as many parts as
    its ids have high bits: one or two, if they count ticks. The hash aggregate over raw ticks works on longs only.
    """
    span = pd.Timedelta(interval) // pd.Timedelta(microseconds=1)
    bits = 63 - span.bit_length()
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    offset = F.pmod(micros, F.lit(span))
    low = F.col("tick_id").cast("long").bitwiseAND(F.lit((1 << bits) - 1))
    traded = F.col("price").isNotNull()  # a tick without price is no trade
    keyed = ticks.filter("ts is not null").select(
        "symbol",
        (micros - offset).alias("_start"),
        F.shiftright(F.col("tick_id").cast("long"), bits).alias("_ids"),
        F.when(traded, F.shiftleft(offset, bits).bitwiseOR(low)).alias("_at"),
        "price",
        F.when(traded, _size(ticks)).alias("_size"),
    )
    parts = keyed.groupBy("symbol", "_start", "_ids").agg(
        F.min("_at").alias("_first"),
        F.max("_at").alias("_last"),
        F.min_by("price", "_at").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "_at").alias("close"),
        F.coalesce(F.sum("_size"), F.lit(0).cast("long")).alias("volume"),
    )
    ends = []
    for end in ("first", "last"):
        key = F.col(f"_{end}")
        ends.append(F.timestamp_micros(F.col("_start") + F.shiftright(key, bits)).alias(f"{end}_ts"))
        ends.append(F.shiftleft("_ids", bits).bitwiseOR(key.bitwiseAND(F.lit((1 << bits) - 1))).alias(f"{end}_id"))
    return parts.select(
        "symbol", F.timestamp_micros("_start").alias("datetime"), "open", "high", "low", "close", "volume", *ends
    )


def merge_partials(parts: DataFrame) -> DataFrame:
    """Bars from all their parts, in whatever order the ticks came."""
    return parts.groupBy("symbol", "datetime").agg(
        F.min_by("open", order_key("first_ts", "first_id")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order_key("last_ts", "last_id")).alias("close"),
        F.sum("volume").alias("volume"),
    )


def resample(ticks: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Bars keyed by (symbol, datetime = start of the interval, UTC); intervals without ticks have no bar."""
    return merge_partials(partial_bars(ticks, interval))
