"""High-water marks and the row ranges they select."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BACKFILL = timedelta(days=720)
OVERLAP = timedelta(hours=2)
RECENT = timedelta(hours=48)


def instant(value: datetime | Column) -> Column:
    """A timestamp column from a column or a UTC datetime."""
    return value if isinstance(value, Column) else from_micros(micros(value))


def micros(value: datetime) -> int:
    """Microseconds since 1970 of an instant; one without a zone is in UTC."""
    aware = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def from_micros(value: int | None) -> Column:
    """The instant as a literal. Numbers, not datetimes, cross to the driver and back: those would go
    through the driver's zone, in which an hour may occur twice."""
    return F.timestamp_micros(F.lit(value).cast("long"))


def high_water_mark(df: DataFrame) -> DataFrame:
    """(symbol, max_dt): the newest instant each symbol has reached."""
    return df.groupBy("symbol").agg(F.max("datetime").alias("max_dt"))


def from_mark(
    df: DataFrame, marks: DataFrame, inclusive: bool, overlap: timedelta | None = None
) -> DataFrame:
    """Rows at or past (``inclusive``) or strictly past their symbol's mark, less ``overlap``.

    A symbol without a mark has not been loaded yet and keeps all its rows. The join carries no hint:
    Spark broadcasts the marks only while they are small. Stage them first, so that it knows.
    """
    bound = F.col("max_dt") - F.lit(overlap) if overlap else F.col("max_dt")
    past = F.col("datetime") >= bound if inclusive else F.col("datetime") > bound
    return df.join(marks, "symbol", "left").filter(F.col("max_dt").isNull() | past).drop("max_dt")


def overlap_range(df: DataFrame, marks: DataFrame, overlap: timedelta = OVERLAP) -> DataFrame:
    """Rows to fetch again: everything from the mark less the overlap."""
    return from_mark(df, marks, inclusive=True, overlap=overlap)


def backfill_range(df: DataFrame, as_of: datetime | Column, span: timedelta = BACKFILL) -> DataFrame:
    """First load: rows no older than ``span`` before ``as_of``."""
    return df.filter(F.col("datetime") >= instant(as_of) - F.lit(span))


def recent(df: DataFrame, as_of: datetime | Column, span: timedelta = RECENT) -> DataFrame:
    """Rows of the last ``span`` before ``as_of``."""
    return df.filter(F.col("datetime") >= instant(as_of) - F.lit(span))


def latest_row(df: DataFrame) -> DataFrame:
    """Each symbol's newest row.

    One max_by per column over the same unique order: with fixed-width columns this is a hash aggregate
    that leaves one row per symbol and task before the shuffle.
    """
    rest = [c for c in df.columns if c not in ("symbol", "datetime")]
    return (
        df.groupBy("symbol")
        .agg(F.max("datetime").alias("datetime"), *[F.max_by(c, "datetime").alias(c) for c in rest])
        .select(*df.columns)
    )


def with_carry(loaded: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh rows together with each symbol's newest loaded row, matched by column name."""
    return latest_row(loaded).unionByName(fresh, allowMissingColumns=True)


def newest(df: DataFrame, count: int) -> DataFrame:
    """The ``count`` newest rows overall, symbol breaking ties (a top-k report)."""
    return df.orderBy(F.col("datetime").desc(), "symbol").limit(count)
