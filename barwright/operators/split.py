"""Time-ordered train/test split, per symbol or at one instant for all symbols."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.operators.chunks import CHUNK, HOUR, ROWS_PER_CHUNK, time_chunk
from barwright.operators.marks import from_micros
from barwright.sources.staging import stage

TRAIN_RATIO = 0.8


def cut_instants(
    df: DataFrame, ratio: float = TRAIN_RATIO, step: timedelta = HOUR, rows: int = ROWS_PER_CHUNK
) -> DataFrame:
    """(symbol, cut): the instant of each symbol's row number int(n * ratio), counting from 1.

    Rows are counted per time chunk; only the one chunk per symbol that holds the cut is sorted. The
    table of these chunks is staged, so that the join sees its size.
    """
    chunked = df.select("symbol", "datetime").withColumn(CHUNK, time_chunk("datetime", step, rows))
    series = Window.partitionBy("symbol")
    earlier = series.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    located = (
        chunked.groupBy("symbol", CHUNK)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_size").over(earlier), F.lit(0)),
                "_wanted": F.floor(F.sum("_size").over(series) * F.lit(ratio)).cast("long"),
            }
        )
        .filter((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_size")))
        .select("symbol", CHUNK, (F.col("_wanted") - F.col("_before")).alias("_nth"))
    )
    place = F.row_number().over(Window.partitionBy("symbol", CHUNK).orderBy("datetime"))
    return (
        chunked.join(stage(located, "cut-chunks"), ["symbol", CHUNK])
        .withColumn("_place", place)
        .filter(F.col("_place") == F.col("_nth"))
        .select("symbol", F.col("datetime").alias("cut"))
    )


def time_split(
    df: DataFrame, ratio: float = TRAIN_RATIO, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``is_train``: true for the first int(n * ratio) rows of each symbol.

    A whole series is numbered in one window; a long one is compared with its cut instant.
    """
    if rows is None:
        series = Window.partitionBy("symbol")
        first = F.floor(F.count(F.lit(1)).over(series) * F.lit(ratio))
        return df.withColumn("is_train", F.row_number().over(series.orderBy("datetime")) <= first)
    cuts = stage(cut_instants(df, ratio, step, rows), "cuts")
    return (
        df.join(cuts, "symbol", "left")
        .withColumn("is_train", F.coalesce(F.col("datetime") <= F.col("cut"), F.lit(False)))
        .drop("cut")
    )


def common_cut(df: DataFrame, ratio: float = TRAIN_RATIO, step: timedelta = HOUR, rows: int = ROWS_PER_CHUNK) -> int | None:
    """The first instant, in microseconds, whose rows are not all among the first int(n * ratio) of the table in the
    order of time; None if all are.

    Rows are counted per time chunk, then per instant inside the one chunk that holds the cut: at most ``rows`` instants.
    """
    chunk = time_chunk("datetime", step, rows)
    over_all = Window.partitionBy(F.lit(0))
    earlier = over_all.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(chunk.alias(CHUNK)).agg(F.count(F.lit(1)).alias("_size"))  # one row per chunk
    wanted = F.floor(F.sum("_size").over(over_all) * F.lit(ratio)).cast("long")
    placed = sizes.withColumns({"_before": F.coalesce(F.sum("_size").over(earlier), F.lit(0)), "_wanted": wanted})
    found = placed.filter((F.col("_before") <= F.col("_wanted")) & (F.col("_wanted") < F.col("_before") + F.col("_size"))).first()
    if found is None:
        return None
    span = step // timedelta(microseconds=1) * rows
    start = found[CHUNK] * span
    at = F.unix_micros("datetime")
    inside = df.filter((F.col("datetime") >= from_micros(start)) & (F.col("datetime") < from_micros(start + span)))
    instants = inside.groupBy(at.alias("_at")).agg(F.count(F.lit(1)).alias("_size"))
    so_far = F.sum("_size").over(over_all.orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    left = found["_wanted"] - found["_before"]
    return instants.withColumn("_so_far", so_far).filter(F.col("_so_far") > left).agg(F.min("_at")).first()[0]


def common_split(df: DataFrame, ratio: float = TRAIN_RATIO, step: timedelta = HOUR, rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``is_train`` by one cut for all symbols: no training row is as late as a test row."""
    cut = common_cut(df, ratio, step, rows)
    return df.withColumn("is_train", F.lit(True) if cut is None else F.col("datetime") < from_micros(cut))


def train_test(
    df: DataFrame,
    ratio: float = TRAIN_RATIO,
    step: timedelta = HOUR,
    rows: int | None = ROWS_PER_CHUNK,
    common: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The rows before each symbol's cut and those after it; ``common``, one cut for all symbols."""
    marked = common_split(df, ratio, step, rows or ROWS_PER_CHUNK) if common else time_split(df, ratio, step, rows)
    return (
        marked.filter("is_train").drop("is_train"),
        marked.filter(~F.col("is_train")).drop("is_train"),
    )


def train_validation_test(
    df: DataFrame,
    validation: float,
    ratio: float = TRAIN_RATIO,
    step: timedelta = HOUR,
    rows: int | None = ROWS_PER_CHUNK,
    common: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``train_test``, with the last ``validation`` share of the training rows set apart."""
    head, test = train_test(df, ratio, step, rows, common)
    train, held_out = train_test(head, 1 - validation, step, rows, common)
    return train, held_out, test
