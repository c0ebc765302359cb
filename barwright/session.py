"""Session settings used by the tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def pin_utc(spark: SparkSession) -> None:
    """Calendar parts, partition dates and day bars are in UTC, whatever the cluster's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def local_session(cpus: int = 8, app: str = "barwright", memory: str = "12g") -> SparkSession:
    """A single-machine session. On a cluster, pass the cluster's own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="barwright-wh-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
