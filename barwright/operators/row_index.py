"""Global row numbers and windows over raw rows, for orders in which any key or instant may be hot."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from barwright.operators.chunks import CHUNK, HALO, fill_forward
from barwright.sources.staging import stage

MAX_CHUNK_ROWS = 1_000_000
MIN_CHUNK_ROWS = 1_000
#: Rows to a partition of the range shuffle, where the session's number of partitions would give more.
PARTITION_ROWS = 4_000_000
_POSITION = "_position"


def row_index(df: DataFrame, order: Sequence[str], name: str = "rn", partitions: int | None = None) -> DataFrame:
    """Number all rows 0, 1, 2, … by ``order``, which must be a unique key.

    A range shuffle puts equal shares of the order into the partitions, so no instant or key is too
    large for a task as long as the last order column tells its rows apart. The sorted rows are staged
    with their position inside the partition (range bounds are sampled, so they must be drawn once),
    and the number of rows in the partitions before is added. That table has one row per partition.
    """
    spark = df.sparkSession
    count = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.count() // PARTITION_ROWS)
    ordered = df.repartitionByRange(count, *order).sortWithinPartitions(*order)
    placed = stage(ordered.withColumn(_POSITION, F.monotonically_increasing_id()), "row-index")
    placed = placed.withColumn("_part", F.shiftright(_POSITION, 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.col(_POSITION).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")  # at most ``count`` rows
        .withColumn(name, F.col("_offset") + inside)
        .drop("_part", "_offset", _POSITION)
    )


def chunk_rows(indexed: DataFrame) -> int:
    """Rows per chunk: enough chunks for the shuffle partitions, none beyond a fixed size."""
    partitions = int(indexed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = indexed.count() // (4 * partitions)
    return max(MIN_CHUNK_ROWS, min(MAX_CHUNK_ROWS, wanted))


def over_rows(
    indexed: DataFrame,
    columns: Callable[[WindowSpec], Sequence[dict[str, Column]]],
    before: int = 0,
    after: int = 0,
    index: str = "rn",
    rows: int = MAX_CHUNK_ROWS,
) -> DataFrame:
    """Add windowed columns over a row-indexed frame, ``rows`` rows per chunk.

    The index says which rows are near a chunk's border, so the halo is copied while the rows pass by:
    one scan, one shuffle. Frames may reach ``before`` rows back and ``after`` rows ahead.
    """
    if rows < max(before, after, 1):
        raise ValueError(f"chunks of {rows} rows cannot hold a halo of {before} + {after} rows")
    inside = F.col(index) % rows
    own = F.floor(F.col(index) / rows).cast("long")
    homes = F.array_compact(
        F.array(
            F.col("_own"),
            F.when(inside >= rows - before, F.col("_own") + 1),
            F.when((inside < after) & (F.col("_own") > 0), F.col("_own") - 1),
        )
    )
    spread = (
        indexed.withColumn("_own", own)
        .withColumn(CHUNK, F.explode(homes))
        .withColumn(HALO, F.col(CHUNK) != F.col("_own"))
        .drop("_own")
    )
    window = Window.partitionBy(CHUNK).orderBy(index)
    added = reduce(lambda d, level: d.withColumns(level), columns(window), spread)
    return added.filter(~F.col(HALO)).drop(CHUNK, HALO)


def fill_rows(
    indexed: DataFrame, value: Column, name: str, index: str = "rn", rows: int = MAX_CHUNK_ROWS
) -> DataFrame:
    """Forward fill over a row-indexed frame; see ``fill_forward``."""
    chunk = F.floor(F.col(index) / rows).cast("long")
    return fill_forward(indexed, value, name, chunk, order=index)
