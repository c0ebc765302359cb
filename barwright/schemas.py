"""Explicit schemas of the layers. Column order is the stored order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["symbol", "datetime"]

_KEY_FIELDS = [
    T.StructField("symbol", T.StringType(), False),
    T.StructField("datetime", T.TimestampType(), False),
]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _ints(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.IntegerType()) for n in names]


TICKS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("tick_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
    ]
)
BARS = T.StructType(
    _KEY_FIELDS + _doubles("open", "high", "low", "close") + [T.StructField("volume", T.LongType())]
)
BRONZE = T.StructType(BARS.fields + [T.StructField("ingest_seq", T.LongType())])
SILVER = T.StructType(
    BARS.fields
    + _doubles("price_change", "price_change_pct", "range", "avg_price")
    + _ints("year", "month", "day", "hour", "day_of_week")
)
GOLD = T.StructType(
    SILVER.fields
    + _doubles(
        "lag_1", "lag_3", "lag_6", "return_1h", "price_range", "volume_change",
        "sma_6", "sma_12", "sma_24", "rolling_std_12", "target_price",
    )
)
SERVING = T.StructType(_KEY_FIELDS + _doubles("actual_close", "predicted_close"))
PREDICTIONS = T.StructType(
    _KEY_FIELDS + [T.StructField("run_id", T.StringType(), False)] + _doubles("close", "prediction")
)
PARTIALS = T.StructType(
    [
        *BARS.fields,
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("ingest_seq", T.LongType(), False),
        T.StructField("date", T.DateType()),
    ]
)
TAKEN = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modified", T.TimestampType()),
        T.StructField("size", T.LongType()),
        T.StructField("ingest_seq", T.LongType(), False),
    ]
)
MARKS = T.StructType([T.StructField("symbol", T.StringType(), False), T.StructField("max_dt", T.TimestampType(), False)])
LOADS = T.StructType([T.StructField("as_of", T.TimestampType(), False)])
PROGRESS = T.StructType(
    [T.StructField("layer", T.StringType(), False), T.StructField("ingest_seq", T.LongType(), False)]
)
MODEL_RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_order", T.IntegerType(), False),
        *_doubles("reg", "enet", "rmse", "mse", "mae", "r2"),
        T.StructField("run_by", T.StringType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order and cast the schema's columns, null-fill absent nullable ones; others follow as they are.

    A missing key column is an error. No column is dropped: a table takes new ones on (``replace_rows``).
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have and not f.nullable]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    named = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*named, *[F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()])
