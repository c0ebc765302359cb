"""Loading ticks as they arrive, in files or micro-batches, each tick once.

What a load's ticks add to bars is appended to a table of partial bars under the load's number. The bars that they touch
are merged from all their parts, so ticks may be as late as they like and symbols as new, and nothing that was read
before is read again. What a load has taken is listed by path; lists and parts of loads that were never published do
not count, so a load that broke off is simply repeated under another number.

Bronze is loaded in this way from its beginning, or by ``run_bronze``, not by both.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright import schemas
from barwright.operators.bars import merge_partials, partial_bars
from barwright.operators.marks import BACKFILL, instant
from barwright.plans.layers import Layers, follow, job, publish, reserve, write_bars
from barwright.schemas import KEYS
from barwright.sources import tables
from barwright.sources.staging import stage


def files_in(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, modified, size) of the files in a folder and those below it; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(folder).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def _published(spark: SparkSession, layers: Layers) -> DataFrame | None:
    progress = tables.load_or_none(spark, layers.name("progress"))
    return None if progress is None else progress.filter("layer = 'bronze'").select("ingest_seq").distinct()


def not_taken(found: DataFrame, layers: Layers) -> DataFrame:
    """The rows (path, modified, size) of ``found`` that no published load has taken; a file that was changed after
    it was taken is an error, as its ticks cannot be told from those that are loaded already."""
    spark = found.sparkSession
    listed, published = tables.load_or_none(spark, layers.name("taken")), _published(spark, layers)
    if listed is None or published is None:
        return found
    seen = listed.join(published, "ingest_seq", "left_semi")
    seen = seen.select("path", F.col("modified").alias("_modified"), F.col("size").alias("_size"))
    both = stage(found.join(seen, "path", "left"), "files")
    changed = both.filter(~(F.col("modified").eqNullSafe(F.col("_modified")) & F.col("size").eqNullSafe(F.col("_size"))))
    changed = [r["path"] for r in changed.filter(F.col("_size").isNotNull()).select("path").limit(5).collect()]
    if changed:
        raise ValueError(f"files have changed since they were loaded: {changed}")
    return both.filter(F.col("_size").isNull()).select("path", "modified", "size")


def load_ticks(ticks: DataFrame, taken: DataFrame, layers: Layers, oldest: datetime | None = None) -> int:
    """Merge ticks into bronze as one load, which has ``taken`` (path, modified, size); the number of the load.

    Bars that start before ``oldest`` are left out.
    """
    spark = ticks.sparkSession
    store = layers.name("partials")
    if spark.catalog.tableExists(layers.name("bronze")) and not spark.catalog.tableExists(store):
        raise ValueError(f"{layers.name('bronze')} was not loaded by arrival")
    number = reserve(spark, layers)
    parts = partial_bars(ticks, layers.interval)
    if oldest is not None:
        parts = parts.filter(F.col("datetime") >= instant(oldest))
    parts = stage(parts.withColumns({"ingest_seq": F.lit(number).cast("long"), "date": F.to_date("datetime")}), "parts")
    days = tables.dates(parts)
    tables.append_dated(parts, store, schemas.PARTIALS, layers.fmt)
    counted = _published(spark, layers).union(spark.range(number, number + 1).toDF("ingest_seq"))
    stored = tables.load(spark, store).filter(F.col("date").isin(days)).join(counted, "ingest_seq", "left_semi")
    bars = stage(merge_partials(stored.join(parts.select(*KEYS).distinct(), KEYS, "left_semi")), "bars")
    if spark.catalog.tableExists(layers.name("bronze")):
        bars = stage(tables.unlike(bars, layers.name("bronze"), schemas.BRONZE, ["ingest_seq"]), "changed")
    if not bars.isEmpty():
        write_bars(bars, layers, number)
    tables.append(taken.withColumn("ingest_seq", F.lit(number).cast("long")), layers.name("taken"), schemas.TAKEN, layers.fmt)
    publish(spark, layers, number)
    return number


def run_arrivals(
    spark: SparkSession,
    folder: str,
    layers: Layers,
    as_of: datetime,
    read: Callable[[list[str]], DataFrame],
    pattern: str = "*.parquet",
    all_layers: bool = True,
) -> int:
    """Load the files of a folder that no load has taken, and bring the later layers up; the number of new files.

    ``read`` makes ticks of paths; only new files are opened. Bars of the last 720 days count, as in a first load.
    """
    with job(spark):
        tables.create_schema(spark, layers.database)
        new = stage(not_taken(files_in(spark, folder, pattern), layers), "new-files")
        paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", r["path"]) for r in new.select("path").collect()]  # a plan holds its paths anyway
        if paths:
            load_ticks(read(paths), new, layers, as_of - BACKFILL)
        if all_layers:
            follow(spark, layers)
    return len(paths)


def run_batch(ticks: DataFrame, layers: Layers, name: str, all_layers: bool = True) -> bool:
    """Load a micro-batch of ticks under a name that tells it from all others, unless it is loaded already."""
    spark = ticks.sparkSession
    with job(spark):
        tables.create_schema(spark, layers.database)
        taken = spark.createDataFrame([(name,)], "path string").select("path", F.lit(None).cast("timestamp").alias("modified"), F.lit(0).cast("long").alias("size"))
        new = not not_taken(taken, layers).isEmpty()
        if new:
            load_ticks(stage(ticks, "batch"), taken, layers)
        if all_layers:
            follow(spark, layers)
    return new
