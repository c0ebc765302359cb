"""Reading ticks and bars from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barwright.schemas import BARS


def event_ticks(events: DataFrame) -> DataFrame:
    """Events as price ticks: the event type is the symbol, the value the price."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("tick_id"),
        F.col("value").alias("price"),
    )


def with_size(ticks: DataFrame, traded: Column) -> DataFrame:
    """Ticks with the size 1 where ``traded`` holds, else 0."""
    return ticks.withColumn("size", F.when(traded, 1).otherwise(0))


def read_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ticks(spark.read.parquet(f"{sf_dir}/events.parquet"))


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType = BARS) -> DataFrame:
    """Bars from Parquet, CSV or JSON files under a declared schema (nothing is inferred)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def flat_lower(df: DataFrame) -> DataFrame:
    """Struct columns unnested one level, then all column names in lower case."""
    flat: list = []
    for field in df.schema.fields:
        if isinstance(field.dataType, StructType):
            flat += [F.col(f"`{field.name}`.`{inner}`").alias(inner) for inner in field.dataType.names]
        else:
            flat.append(F.col(f"`{field.name}`"))
    out = df.select(*flat)
    return out.toDF(*[c.lower() for c in out.columns])


def stream_ticks(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """The events files as a tick stream."""
    reader = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A glob, because a stream takes a plain path only when it is a folder.
    return event_ticks(reader.parquet(f"{sf_dir}/events.parque[t]"))
