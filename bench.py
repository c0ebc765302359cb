"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3,
after a warm-up of the JVM by some of the queries and one of each query; the median counts). The plain_* entries are the same results from whole-series or unpartitioned
windows, or from one evaluator pass per metric, for comparison; "layers" times the batch jobs: a first load, one more
hour, and a load without news. Neither is part of the total. BENCH_TRIALS=1 adds single runs over the events
repeated to 20 million rows at sf0.1.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid
from datetime import timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright import catalogue
from barwright.operators import features as ft
from barwright.operators.clean import silver
from barwright.operators.marks import instant
from barwright.plans.layers import Layers, run_layers
from barwright.session import local_session

HEADLINE = [
    "ohlcv_bars", "daily_bars", "dedup_bars", "volume_ffill", "silver_features", "gold_features",
    "gold_chunked", "gold_incremental", "gold_revision", "global_row_index", "rolling_chunked",
    "ffill_chunked", "time_split", "scaler_stats", "eval_metrics", "best_run", "model_grid",
    "serving_shift", "recent_48h", "updown_counts", "rsi_14", "stream_bars",
]

WARM_UP = ["ohlcv_bars", "dedup_bars", "gold_chunked", "time_split"]


def write_out(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def plain_gold(spark, path):
    """The same rows from whole-series windows by symbol, nothing staged or measured before."""
    return ft.gold(silver(catalogue._hourly(spark, path), rows=None), rows=None)


def increments(spark, path) -> dict[str, float]:
    """Seconds of a first load of all layers, of one more hour, and of a load that finds nothing new."""
    ticks = catalogue._ticks(spark, path).cache()
    layers = Layers(f"bench_{uuid.uuid4().hex}")
    end = ticks.agg(F.max("ts")).first()[0].replace(tzinfo=None)
    out = {}
    try:
        for name, at in (("full_load", end - timedelta(hours=1)), ("last_hour", end), ("nothing_new", end)):
            begun = time.perf_counter()
            run_layers(ticks.filter(F.col("ts") <= instant(at)), layers, at)
            out[name] = round(time.perf_counter() - begun, 3)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {layers.database} CASCADE")
        ticks.unpersist()
    return out


def trials(spark, path, copies: int = 200) -> dict[str, float]:
    """Long series without a key, in chunks and in one partition: the events repeated with new ids and times."""
    events = spark.read.parquet(f"{path}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    n = events.count()
    shifted = F.timestamp_micros(F.unix_micros("ts") + F.col("copy") * 30 * 86_400_000_000)
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartition(64)
    many = many.select((F.col("event_id") + F.col("copy") * n).alias("event_id"), shifted.alias("ts"), "value")
    folder = tempfile.mkdtemp(prefix="bench-")
    many.write.parquet(f"{folder}/events.parquet")
    out = {"rows": n * copies}
    for name, query in (("rolling_chunked", catalogue.QUERIES["rolling_chunked"]), ("plain_rolling", plain_rolling),
                        ("ffill_chunked", catalogue.QUERIES["ffill_chunked"]), ("plain_ffill", plain_ffill),
                        ("ohlcv_bars", catalogue.QUERIES["ohlcv_bars"])):
        begun = time.perf_counter()
        write_out(query(spark, folder))
        out[name] = round(time.perf_counter() - begun, 3)
    return out


def plain_rolling(spark, path):
    w = Window.orderBy("ts", "event_id")
    return spark.read.parquet(f"{path}/events.parquet").select(
        "event_id",
        F.lag("value", 6).over(w).alias("lag_6"),
        F.avg("value").over(w.rowsBetween(-23, 0)).alias("sma_24"),
        F.stddev_samp("value").over(w.rowsBetween(-11, 0)).alias("std_12"),
        F.lead("value", 1).over(w).alias("lead_1"),
    )


def plain_ffill(spark, path):
    w = Window.orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col("value") >= 40, F.col("value"))
    events = spark.read.parquet(f"{path}/events.parquet")
    return events.select("event_id", F.last(known, ignorenulls=True).over(w).alias("filled"))


def plain_metrics(spark, path):
    _, test = catalogue._train_test(spark, path)
    values = {
        m: RegressionEvaluator(labelCol="target_price", predictionCol="close", metricName=m).evaluate(test)
        for m in ("rmse", "mse", "mae", "r2")
    }
    return spark.createDataFrame([tuple(values.values())], list(values))


PLAIN = {
    "plain_gold": plain_gold,
    "plain_rolling": plain_rolling,
    "plain_ffill": plain_ffill,
    "plain_metrics": plain_metrics,
}


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")

    def measure(query) -> float:
        times = []
        for i in range(runs + 1):
            begun = time.perf_counter()
            write_out(query(spark, path))
            if i:
                times.append(time.perf_counter() - begun)
        return round(statistics.median(times), 3)

    for name in WARM_UP * 2:  # else the first queries are charged for class loading and compilation
        write_out(catalogue.QUERIES[name](spark, path))
    seconds = {name: measure(catalogue.QUERIES[name]) for name in HEADLINE}
    compared = {name: measure(query) for name, query in PLAIN.items()}
    ticks = spark.read.parquet(f"{path}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "compared": compared,
                "layers": increments(spark, path),
                **({"trials": trials(spark, path)} if os.environ.get("BENCH_TRIALS") else {}),
                "ticks": ticks,
                "sf": path.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
