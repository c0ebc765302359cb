"""Bars and layers from a stream of ticks.

``stream_bars`` keeps the open bars in the state of the stream and drops ticks that come later than its watermark.
``write_ticks`` keeps no state: each micro-batch is merged into the stored partial bars, however late its ticks are.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barwright.operators.bars import bar_aggregates
from barwright.plans.ingest import run_batch
from barwright.plans.layers import Layers, follow, store_bars
from barwright.schemas import BARS
from barwright.sources import tables
from barwright.sources.staging import scratch, stage

LATENESS = timedelta(hours=2)


def stream_bars(ticks: DataFrame, interval: str = "1 hour", lateness: timedelta = LATENESS) -> DataFrame:
    """Bars of a tick stream; a bar is final once the watermark, ``lateness`` behind, has passed its end."""
    return (
        ticks.withWatermark("ts", f"{int(lateness.total_seconds())} seconds")
        .groupBy("symbol", F.window("ts", interval))
        .agg(*bar_aggregates(ticks))
        .select("symbol", F.col("window.start").alias("datetime"), "open", "high", "low", "close", "volume")
    )


def write_bars(bars: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished bars as Parquet files, exactly once, until the available input is used up."""
    return (
        bars.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def written_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BARS).parquet(path)


def write_layers(bars: DataFrame, layers: Layers, checkpoint: str) -> StreamingQuery:
    """Run the bronze, silver, gold and serving increments on every micro-batch of finished bars.

    A batch that is replayed after a failure replaces its own rows.
    """

    def increment(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            finished = stage(batch, "batch")  # the stateful plan runs once
            if finished.isEmpty():
                return
            tables.create_schema(spark, layers.database)
            store_bars(finished, layers)
        follow(spark, layers)

    return (
        bars.writeStream.foreachBatch(increment)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_ticks(ticks: DataFrame, layers: Layers, checkpoint: str, name: str = "ticks", all_layers: bool = True) -> StreamingQuery:
    """Load every micro-batch of ticks and bring the layers up; of two streams into one database, ``name`` differs.

    Bars are there from their first tick on and change with every later one. A batch that is replayed after a failure
    counts once.
    """

    def increment(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch, layers, f"{name}/{batch_id}", all_layers)

    return (
        ticks.writeStream.foreachBatch(increment)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
