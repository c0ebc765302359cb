"""Scaled elastic-net regressions over a parameter grid, and next-step forecasts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.operators.marks import latest_row
from barwright.plans.metrics import best_run, evaluate_runs

# Model inputs, label and parameter grid.
FEATURES = [
    "close", "volume", "price_change_pct", "hour", "day_of_week", "lag_1", "lag_3",
    "return_1h", "volume_change", "sma_6", "sma_12", "rolling_std_12",
]
LABEL = "target_price"
REG = [0.01, 0.1, 1.0]
ELASTIC_NET = [0.0, 0.5, 1.0]

PARALLEL_FITS = 8


def assembler(columns: Sequence[str] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def fit_scaler(train: DataFrame, columns: Sequence[str] = FEATURES) -> StandardScalerModel:
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)
    return scaler.fit(assembler(columns).transform(train.select(*columns)))


def scaler_stats(train: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, mean, std): what the scaler subtracts and divides by, from one aggregate."""
    one_row = train.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns]
    )
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}.mean").alias("mean"), F.col(f"{c}.std").alias("std"))
        for c in columns
    ]
    return one_row.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def scaled(df: DataFrame, scaler: StandardScalerModel, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``z_<feature>`` columns."""
    vectors = scaler.transform(assembler(columns).transform(df))
    values = vectors.withColumn("_z", vector_to_array("scaled_features")).drop("features", "scaled_features")
    return values.withColumns({f"z_{c}": F.col("_z")[i] for i, c in enumerate(columns)}).drop("_z")


@dataclass
class Grid:
    """The fitted models of a grid, in run order, and their scores (run_order, reg, enet, 4 metrics)."""

    models: list[PipelineModel]
    runs: DataFrame

    def best(self) -> PipelineModel:
        return self.models[best_run(self.runs).first()["run_order"]]


def _centred(columns: Sequence[str], scaler: StandardScalerModel) -> dict[str, Column]:
    """The scaled features as plain expressions; a constant feature becomes 0, as the scaler makes it."""
    means, stds = scaler.mean, scaler.std
    return {c: (F.col(c).cast("double") - F.lit(float(means[i]))) * F.lit(1 / stds[i] if stds[i] else 0.0) for i, c in enumerate(columns)}


def moments(train: DataFrame, scaler: StandardScalerModel, columns: Sequence[str] = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Means and (population) covariances of the scaled features and, last, the label: from one aggregate of all their
    products. The label is centred by a rough mean first, so that little is lost to rounding."""
    rough = train.select(LABEL).first()
    if rough is None:
        raise ValueError("no training rows")
    values = [*_centred(columns, scaler).values(), F.col(LABEL) - F.lit(rough[0])]
    rows = train.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    k = len(values)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    averages = [F.avg(f"v{i}") for i in range(k)] + [F.avg(F.col(f"v{i}") * F.col(f"v{j}")) for i, j in pairs]
    found = np.array(rows.agg(*[x.alias(f"a{i}") for i, x in enumerate(averages)]).first(), float)
    mean, products = found[:k], np.zeros((k, k))
    for (i, j), v in zip(pairs, found[k:], strict=True):
        products[i, j] = products[j, i] = v
    covariance = products - np.outer(mean, mean)
    mean[-1] += rough[0]
    return mean, covariance


def stand_in(mean: np.ndarray, covariance: np.ndarray) -> np.ndarray:
    """A few rows with these means and covariances. A least-squares line, penalised or not, depends on its rows only
    through those, so a trainer finds the same line from these rows as from all."""
    k = len(mean)
    n = k + 1
    # orthonormal columns whose entries add up to 0
    basis = np.linalg.qr(np.concatenate([np.ones((n, 1)), np.eye(n)[:, :k]], axis=1))[0][:, 1:]
    values, vectors = np.linalg.eigh(covariance)
    rows = mean + np.sqrt(n) * basis @ (vectors * np.sqrt(np.maximum(values, 0))).T
    return np.where(np.diag(covariance) > 0, rows, mean)  # a constant stays one


def fit_grid(
    train: DataFrame,
    test: DataFrame,
    reg: Sequence[float] = REG,
    elastic_net: Sequence[float] = ELASTIC_NET,
    columns: Sequence[str] = FEATURES,
) -> Grid:
    """Fit every (reg, elastic net) pair on ``train`` and score all of them on ``test`` in one pass.

    The scaler sees the same rows at every grid point, so it is fitted once. One more pass over the training rows sums
    up all products of features and label; the fits themselves are the library's, on a few rows with the same sums.
    """
    spark = train.sparkSession
    pack = assembler(columns)
    scaler = fit_scaler(train, columns)
    few = [(Vectors.dense(r[:-1]), float(r[-1])) for r in stand_in(*moments(train, scaler, columns))]
    rows = spark.createDataFrame(few, ["scaled_features", LABEL]).coalesce(1).persist()
    pairs = [(r, e) for r in reg for e in elastic_net]
    line = LinearRegression(featuresCol="scaled_features", labelCol=LABEL)
    settings = [{line.regParam: r, line.elasticNetParam: e} for r, e in pairs]
    try:
        with ThreadPool(PARALLEL_FITS) as pool:
            fits = line.fitMultiple(rows, settings)
            fitted = dict(pool.imap_unordered(lambda _: next(fits), pairs))
    finally:
        rows.unpersist()
    scores = test.select(*[v.alias(f"_z{i}") for i, v in enumerate(_centred(columns, scaler).values())], LABEL)
    runs = []
    for i, (r, e) in enumerate(pairs):
        terms = [F.lit(float(w)) * F.col(f"_z{j}") for j, w in enumerate(fitted[i].coefficients) if w]
        scores = scores.withColumn(f"p{i}", reduce(lambda a, b: a + b, terms, F.lit(float(fitted[i].intercept))))
        runs.append({"reg": r, "enet": e, "column": f"p{i}"})
    models = [PipelineModel([pack, scaler, fitted[i]]) for i in range(len(pairs))]
    return Grid(models, evaluate_runs(scores, LABEL, runs, "column"))


def plain_line(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(term, value): intercept and slopes of the least-squares line from ``columns`` to the label."""
    line = LinearRegression(featuresCol="features", labelCol=LABEL, regParam=0.0)
    fitted = line.fit(assembler(columns).transform(train.select(*columns, LABEL)))
    terms = [("intercept", float(fitted.intercept)), *zip(columns, map(float, fitted.coefficients), strict=True)]
    return train.sparkSession.createDataFrame(terms, "term string, value double")


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(symbol, datetime, close, prediction) for each row: the forecast of the next close."""
    return model.transform(rows).select("symbol", "datetime", "close", "prediction")


def next_step(model: PipelineModel, gold: DataFrame) -> DataFrame:
    """The forecast from each symbol's newest row, whose own target is still unknown."""
    return predict(model, latest_row(gold.select("symbol", "datetime", *FEATURES)))
