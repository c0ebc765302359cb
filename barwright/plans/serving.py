"""Tables and reports read by a dashboard."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.functions.expr import to_local
from barwright.operators.chunks import HOUR, ROWS_PER_CHUNK, over_series
from barwright.operators.features import target_column
from barwright.operators.marks import RECENT, newest, recent

LOCAL_ZONE = "Asia/Kolkata"


def next_close(bars: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK) -> DataFrame:
    """Bars with ``target_price``, the close one row ahead; null on the last bar."""
    return over_series(bars, lambda w: [target_column(w)], ["close"], after=1, step=step, rows=rows)


def serving_shift(gold: DataFrame) -> DataFrame:
    """Close and the close that followed it, for rows that have both."""
    return gold.select(
        "symbol", "datetime", F.col("close").alias("actual_close"), F.col("target_price").alias("predicted_close")
    ).dropna()


def recent_local(df: DataFrame, count: int = 5, zone: str = LOCAL_ZONE) -> DataFrame:
    """The newest rows with their time in a local zone; the UTC time orders them but is not returned."""
    rest = [c for c in df.columns if c != "datetime"]
    return newest(df, count).select(to_local("datetime", zone).alias("datetime_local"), *rest)


def prediction_error(served: DataFrame) -> DataFrame:
    """Add ``error`` = |actual - predicted| to the complete rows of a serving table."""
    return served.dropna().withColumn("error", F.abs(F.col("actual_close") - F.col("predicted_close")))


def dashboard(served: DataFrame, as_of: datetime | Column, span: timedelta = RECENT) -> DataFrame:
    """The recent rows of a serving table with their errors, in time order (a bounded result)."""
    return prediction_error(recent(served, as_of, span)).orderBy("datetime", "symbol")


def actual_vs_predicted(predictions: DataFrame, realised: DataFrame) -> DataFrame:
    """Each prediction beside the close that came true, matched on the bar it was made from.

    ``realised`` has (symbol, datetime, target_price). The key is unique on both sides.
    """
    known = realised.select("symbol", "datetime", F.col("target_price").alias("actual")).dropna()
    return predictions.join(known, ["symbol", "datetime"]).withColumnRenamed("prediction", "predicted")


def direction(predicted: Column, current: Column) -> Column:
    move = F.round(predicted - current, 6)
    return F.when(move > 0, "up").when(move < 0, "down").otherwise("flat")


def updown_counts(predictions: DataFrame) -> DataFrame:
    """How many predictions of each symbol point up, down or nowhere."""
    return (
        predictions.groupBy("symbol", direction(F.col("prediction"), F.col("close")).alias("direction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
