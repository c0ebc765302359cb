"""Silver bars to model features (gold)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import WindowSpec

from barwright.functions.expr import present, ratio_change
from barwright.operators.chunks import HOUR, ROWS_PER_CHUNK, over_series
from barwright.schemas import GOLD

LOOK_BACK = 23
LOOK_AHEAD = 1
LAGS = (1, 3, 6)
MEANS = (6, 12, 24)
DEVIATION = 12


def lag_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"lag_{k}": F.lag("close", k).over(w) for k in LAGS}


def mean_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"sma_{n}": F.avg("close").over(w.rowsBetween(1 - n, 0)) for n in MEANS}


def deviation_column(w: WindowSpec) -> dict[str, Column]:
    frame = w.rowsBetween(1 - DEVIATION, 0)
    return {f"rolling_std_{DEVIATION}": F.stddev_samp("close").over(frame)}


def target_column(w: WindowSpec) -> dict[str, Column]:
    return {"target_price": F.lead("close", 1).over(w)}


def return_column() -> dict[str, Column]:
    return {"return_1h": F.round(ratio_change("close", "lag_1"), 6)}


def volume_change_column(w: WindowSpec) -> dict[str, Column]:
    return {"volume_change": F.round(ratio_change("volume", F.lag("volume", 1).over(w)), 6)}


def _levels(w: WindowSpec) -> Sequence[dict[str, Column]]:
    windowed = {
        **lag_columns(w),
        **mean_columns(w),
        **deviation_column(w),
        **target_column(w),
        **volume_change_column(w),
    }
    return [windowed, {**return_column(), "price_range": F.round(F.col("high") - F.col("low"), 6)}]


def features(
    silver: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK, keep: Sequence[str] = ()
) -> DataFrame:
    """All gold columns for every silver row, nulls included, and the ``keep`` columns of the input.

    Lags and frames count rows, not hours.
    """
    return over_series(
        silver, _levels, ["close", "volume"], LOOK_BACK, LOOK_AHEAD, step=step, rows=rows
    ).select(*GOLD.fieldNames(), *keep)


def _all_present(columns: Sequence[str]) -> Column:
    doubles = {f.name for f in GOLD.fields if isinstance(f.dataType, DoubleType)}
    return reduce(lambda a, b: a & b, [present(c, c in doubles) for c in columns])


def with_pending(gold: DataFrame) -> DataFrame:
    """Rows whose inputs are all present; the newest row of a symbol may still lack its target."""
    inputs = [c for c in GOLD.fieldNames() if c != "target_price"]
    return gold.filter(_all_present(inputs) & ~F.coalesce(F.isnan("target_price"), F.lit(False)))


def complete_cases(gold: DataFrame) -> DataFrame:
    """Rows without any null or NaN: what training may use."""
    return gold.dropna()


def gold(silver: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK) -> DataFrame:
    return complete_cases(features(silver, step, rows))
