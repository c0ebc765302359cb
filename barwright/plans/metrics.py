"""Regression errors of many predictors in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("rmse", "mse", "mae", "r2")


def error_metrics(actual: str, predicted: str | Column) -> dict[str, Column]:
    """RMSE, MSE, MAE and R² of one prediction column as plain aggregates."""
    y = F.col(actual)
    error = y - (F.col(predicted) if isinstance(predicted, str) else predicted)
    squared = error * error
    spread = F.var_pop(y) * F.count(y)
    return {
        "rmse": F.sqrt(F.avg(squared)),
        "mse": F.avg(squared),
        "mae": F.avg(F.abs(error)),
        "r2": 1 - F.try_divide(F.sum(squared), spread),
    }


def evaluate(predictions: DataFrame, actual: str, predicted: str = "prediction") -> DataFrame:
    """One row with the four metrics."""
    return predictions.agg(*[m.alias(n) for n, m in error_metrics(actual, predicted).items()])


def evaluate_runs(predictions: DataFrame, actual: str, runs: Sequence[dict], predicted_key: str) -> DataFrame:
    """One row per run: its parameters, ``run_order`` and four metrics.

    Each run is a dict of parameters, of which ``predicted_key`` names the run's prediction column and is
    not repeated in the output. All runs are scored by a single aggregate, whatever their number.
    """
    one_row = predictions.agg(
        *[
            F.struct(*[m.alias(n) for n, m in error_metrics(actual, run[predicted_key]).items()]).alias(f"r{i}")
            for i, run in enumerate(runs)
        ]
    )
    rows = [
        F.struct(
            F.lit(i).alias("run_order"),
            *[F.lit(v).alias(k) for k, v in run.items() if k != predicted_key],
            *[F.col(f"r{i}.{n}").alias(n) for n in METRICS],
        )
        for i, run in enumerate(runs)
    ]
    return one_row.select(F.explode(F.array(*rows)).alias("run")).select("run.*")


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the lowest RMSE; the earliest of equals."""
    best = F.min_by(F.struct(*runs.columns), F.struct("rmse", "run_order"))
    return runs.agg(best.alias("run")).select("run.*")
