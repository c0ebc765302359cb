"""Increments that equal a full recompute."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.functions.expr import known_volume
from barwright.operators.chunks import CHUNK, HOUR, ROWS_PER_CHUNK, fill_forward, over_series, time_chunk
from barwright.operators.clean import derive, repair_volume, valid_bars
from barwright.operators.features import LOOK_AHEAD, LOOK_BACK, features, with_pending
from barwright.operators.marks import instant
from barwright.schemas import BARS, KEYS
from barwright.sources.staging import stage


def silver_from(
    bars: DataFrame, before: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Silver for ``bars``, given the newest earlier silver row of each symbol (``before``).

    The earlier row feeds the volume fill (only its volume is read) and is not emitted again.
    """
    fresh = valid_bars(bars).withColumn("_carried", F.lit(False))
    carried = before.select(*KEYS, "volume").withColumn("_carried", F.lit(True))
    repaired = repair_volume(fresh.unionByName(carried, allowMissingColumns=True), step, rows)
    return derive(repaired.filter(~F.col("_carried")).drop("_carried"))


def gold_marks(gold: DataFrame) -> DataFrame:
    """(symbol, max_dt): each symbol's newest gold row that already has its target."""
    done = gold.filter(F.col("target_price").isNotNull())
    return done.groupBy("symbol").agg(F.max("datetime").alias("max_dt"))


def split_at(df: DataFrame, marks: DataFrame, inclusive: bool) -> DataFrame:
    """Add ``_past``: at or past (``inclusive``) or strictly past the symbol's mark; true without a mark."""
    at, mark = F.col("datetime"), F.col("max_dt")
    is_past = mark.isNull() | (at >= mark if inclusive else at > mark)
    return df.join(marks, "symbol", "left").withColumn("_past", is_past).drop("max_dt")


def last_rows(df: DataFrame, count: int) -> DataFrame:
    """Each symbol's ``count`` newest rows, numbered backwards in ``_back``.

    A group limit: each task forwards at most ``count`` rows of a symbol.
    """
    newest_first = Window.partitionBy("symbol").orderBy(F.col("datetime").desc())
    return df.withColumn("_back", F.row_number().over(newest_first)).filter(F.col("_back") <= count)


def last_rows_before(
    history: DataFrame, marks: DataFrame, count: int, horizon: datetime | Column, inclusive: bool
) -> DataFrame:
    """Each symbol's last ``count`` rows ahead of its mark, reading little of a long, dated history.

    Rows from ``horizon`` on are tried first (the filter prunes partitions). Only symbols that have
    fewer than ``count`` rows there are looked up in the whole history, so the result is exact.
    """

    def ahead(part: DataFrame, of: DataFrame) -> DataFrame:
        known = part.join(of.select("symbol"), "symbol", "left_semi")
        return last_rows(split_at(known, of, inclusive).filter(~F.col("_past")).drop("_past"), count)

    since = instant(horizon)
    recent = history.filter((F.col("date") >= F.to_date(since)) & (F.col("datetime") >= since))
    near = stage(ahead(recent, marks), "near")
    enough = near.groupBy("symbol").count().filter(F.col("count") >= count)
    short = marks.join(enough, "symbol", "left_anti")
    if short.isEmpty():
        return near
    short = stage(short, "short")
    return near.join(short, "symbol", "left_anti").unionByName(ahead(history, short))


def gold_with_context(
    past: DataFrame,
    context: DataFrame,
    rows_back: int = 0,
    step: timedelta = HOUR,
    rows: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Gold for the ``past`` rows and the last ``rows_back`` rows of their ``context`` (``last_rows``)."""
    fresh = past.withColumn("_emit", F.lit(True))
    earlier = context.withColumn("_emit", F.col("_back") <= rows_back).drop("_back")
    computed = features(fresh.unionByName(earlier), step, rows, keep=["_emit"])
    return with_pending(computed.filter("_emit")).drop("_emit")


def gold_from(
    silver: DataFrame,
    marks: DataFrame,
    rows_back: int = 0,
    inclusive: bool = False,
    step: timedelta = HOUR,
    rows: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Gold rows past each symbol's mark and the ``rows_back`` rows ahead of them, pending ones included.

    Reads the silver rows past the mark and the 23 + ``rows_back`` before them, so lags and frames see
    the same rows as in a full recompute. A symbol without a mark is computed whole.
    """
    marked = split_at(silver, marks, inclusive)
    past = marked.filter("_past").drop("_past")
    context = last_rows(marked.filter(~F.col("_past")).drop("_past"), LOOK_BACK + rows_back)
    return gold_with_context(past, context, rows_back, step, rows)


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """(symbol, datetime) of the silver rows in ``new`` that ``old`` lacks or holds with other values."""
    values = [c for c in BARS.fieldNames() if c not in KEYS]
    before = old.select(*KEYS, F.struct(*values).alias("_old"))
    after = new.select(*KEYS, F.struct(*values).alias("_new"))
    joined = after.join(before, KEYS, "left")
    return joined.filter(~F.col("_new").eqNullSafe(F.col("_old"))).select(*KEYS)


def rows_near(
    series: DataFrame, changes: DataFrame, back: int, ahead: int, step: timedelta = HOUR, span: int = 512
) -> DataFrame:
    """The rows of ``series`` in time chunks of ``span`` steps that hold a change, and in those with any of the
    ``back`` rows before or the ``ahead`` rows after such a chunk.

    Found from the chunks' row counts, one row per chunk, so gaps of any length are exact; the rest of a long
    series is not sorted or shuffled. Of two stretches that stay apart, no row of one is closer to a change
    of the other than it was.
    """
    chunk = time_chunk("datetime", step, span)
    chunked = series.join(changes.select("symbol").distinct(), "symbol", "left_semi").withColumn(CHUNK, chunk)
    touched = changes.select("symbol", chunk.alias(CHUNK)).distinct().withColumn("_touched", F.lit(True))
    along = Window.partitionBy("symbol").orderBy(CHUNK)
    before, after = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    ends = F.sum("_size").over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = chunked.groupBy("symbol", CHUNK).agg(F.count(F.lit(1)).alias("_size")).join(touched, ["symbol", CHUNK], "left")
    placed = placed.withColumn("_end", ends).withColumn("_start", F.col("_end") - F.col("_size"))
    past = F.last(F.when(F.col("_touched"), F.col("_end")), ignorenulls=True).over(before)
    coming = F.first(F.when(F.col("_touched"), F.col("_start")), ignorenulls=True).over(after)
    placed = placed.withColumns({"_past": past, "_coming": coming})
    near = F.expr(f"_touched OR coalesce(_past + {ahead} > _start, false) OR coalesce(_coming - {back} < _end, false)")
    needed = stage(placed.filter(near).select("symbol", CHUNK), "near-chunks")
    return chunked.join(needed, ["symbol", CHUNK], "left_semi").drop(CHUNK)


def gold_touched_by(
    silver: DataFrame, changes: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Recomputed gold rows, pending ones included, that the changed silver rows can reach.

    A change at T reaches one row back (its target) and 23 ahead, and these read 23 rows back and one ahead. Only
    the stretches of a series around its changes are windowed.
    """
    around = rows_near(silver, changes, LOOK_AHEAD + LOOK_BACK, LOOK_BACK + LOOK_AHEAD, step)
    flagged = around.join(changes.select(*KEYS, F.lit(True).alias("_changed")), KEYS, "left")
    reach = over_series(
        flagged.select(*KEYS, "_changed"),
        lambda w: [{"_hit": F.max("_changed").over(w.rowsBetween(-LOOK_BACK, LOOK_AHEAD))}],
        ["_changed"],
        LOOK_BACK,
        LOOK_AHEAD,
        step=step,
        rows=rows,
    )
    hits = reach.filter(F.col("_hit")).select(*KEYS)
    return with_pending(features(flagged.drop("_changed"), step, rows).join(hits, KEYS, "left_semi"))


def refilled_rows(
    bars: DataFrame, changes: DataFrame, step: timedelta = HOUR, rows: int | None = ROWS_PER_CHUNK
) -> DataFrame:
    """Changed bars plus the zero-volume bars after them, whose filled volume may follow the change.

    ``changes`` holds (symbol, datetime) of revised bars, ``bars`` the bars after the revision. The reach
    of a change ends before the next bar with a volume of its own.
    """
    affected = valid_bars(bars).join(changes.select("symbol").distinct(), "symbol", "left_semi")
    flagged = affected.join(changes.select(*KEYS, F.lit(True).alias("_changed")), KEYS, "left")
    # Along the series, the newest event so far decides: a change starts the reach, a known volume ends it.
    event = F.when(F.col("_changed"), True).when(known_volume().isNotNull(), False)
    marked = fill_forward(
        flagged, event, "_reached", time_chunk("datetime", step, rows), keys=["symbol"], default=F.lit(False)
    )
    return marked.filter("_reached").select(*KEYS)


def merge_rows(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """``stored`` with the rows of ``fresh`` put in place of those with equal keys."""
    return stored.join(fresh.select(*KEYS), KEYS, "left_anti").unionByName(fresh)
