"""Bronze bars to the cleaned silver layer."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.functions.expr import calendar_columns, known_volume, price_columns
from barwright.operators.chunks import HOUR, ROWS_PER_CHUNK, fill_forward, time_chunk
from barwright.schemas import BARS, KEYS

DEFAULT_VOLUME = 1


def latest_wins(bars: DataFrame, version: str = "ingest_seq", unique: bool = False) -> DataFrame:
    """One row per (symbol, datetime): the one with the highest version.

    Rows that tie on the version are ordered by their values, so the survivor never depends on input
    order. It is an aggregate, not a window: copies of one key are combined before the shuffle, however
    many there are. Where the caller knows that no two rows of a key share a version (``unique``), each column
    is taken by itself, which with fixed-width columns is a hash aggregate and needs no sort.
    """
    rest = [c for c in bars.columns if c not in (*KEYS, version)]
    if unique:
        latest = [F.max_by(c, version).alias(c) for c in rest]
        return bars.groupBy(*KEYS).agg(F.max(version).alias(version), *latest).select(*bars.columns)
    return (
        bars.groupBy(*KEYS)
        .agg(F.max(F.struct(version, *rest)).alias("_row"))
        .select(*KEYS, *[F.col(f"_row.{c}").alias(c) for c in bars.columns if c not in KEYS])
    )


def valid_bars(bars: DataFrame) -> DataFrame:
    """The bar columns of the rows that have a close."""
    return bars.select(*BARS.fieldNames()).filter(F.col("close").isNotNull())


def repair_volume(bars: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK) -> DataFrame:
    """Volume 0 or null becomes the symbol's last known volume, or 1 where there is none yet."""
    filled = fill_forward(
        bars,
        known_volume(),
        "volume",
        time_chunk("datetime", step, rows),
        keys=["symbol"],
        default=F.lit(DEFAULT_VOLUME).cast("long"),
    )
    return filled.select(*bars.columns)


def derive(bars: DataFrame) -> DataFrame:
    """Add the price and calendar columns."""
    return bars.withColumns({**price_columns(), **calendar_columns()})


def silver(bars: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK) -> DataFrame:
    """Clean, repaired bars with derived columns. Input keys must be unique (``latest_wins``)."""
    return derive(repair_volume(valid_bars(bars), step, rows))
