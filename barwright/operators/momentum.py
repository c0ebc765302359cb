"""Indicators on daily (or any) bars: relative strength, moving average, return, direction label."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.functions.expr import ratio_change
from barwright.operators.chunks import DAY, ROWS_PER_CHUNK, over_series


def relative_strength(
    bars: DataFrame, periods: int = 14, step: timedelta = DAY, rows: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """``rsi_<periods>``: 100 - 100 / (1 + mean gain / mean loss) over the last ``periods`` changes.

    Null until that many changes exist; 100 when nothing fell; 50 when nothing moved.
    """

    def levels(w):
        frame = w.rowsBetween(1 - periods, 0)
        change = F.col("close") - F.lag("close", 1).over(w)
        moved = F.col("_change").isNotNull()
        gain = F.avg(F.when(moved, F.greatest(F.col("_change"), F.lit(0.0)))).over(frame)
        loss = F.avg(F.when(moved, F.greatest(-F.col("_change"), F.lit(0.0)))).over(frame)
        index = (
            F.when(F.col("_changes") < periods, None)
            .when((F.col("_gain") == 0) & (F.col("_loss") == 0), 50.0)
            .when(F.col("_loss") == 0, 100.0)
            .otherwise(100 - 100 / (1 + F.try_divide(F.col("_gain"), F.col("_loss"))))
        )
        return [
            {"_change": change},
            {"_gain": gain, "_loss": loss, "_changes": F.count("_change").over(frame)},
            {f"rsi_{periods}": index},
        ]

    out = over_series(bars, levels, ["close"], before=periods, step=step, rows=rows)
    return out.drop("_change", "_gain", "_loss", "_changes")


def moving_average(
    bars: DataFrame, periods: int = 7, step: timedelta = DAY, rows: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """``ma_<periods>``: mean close over the last ``periods`` bars, fewer at the start."""
    mean = f"ma_{periods}"
    return over_series(
        bars,
        lambda w: [{mean: F.avg("close").over(w.rowsBetween(1 - periods, 0))}],
        ["close"],
        before=periods - 1,
        step=step,
        rows=rows,
    )


def percent_return(bars: DataFrame, step: timedelta = DAY, rows: int | None = ROWS_PER_CHUNK) -> DataFrame:
    """``return_1d``: percentage change of close against the bar before."""
    return over_series(
        bars,
        lambda w: [{"return_1d": ratio_change(F.col("close"), F.lag("close", 1).over(w)) * 100}],
        ["close"],
        before=1,
        step=step,
        rows=rows,
    )


def direction_label(bars: DataFrame, step: timedelta = DAY, rows: int | None = ROWS_PER_CHUNK) -> DataFrame:
    """``label``: 1 if the next close is higher, else 0; null on the last bar."""

    def levels(w):
        coming = F.lead("close", 1).over(w)
        return [{"label": F.when(coming.isNotNull(), (coming > F.col("close")).cast("int"))}]

    return over_series(bars, levels, ["close"], after=1, step=step, rows=rows)
