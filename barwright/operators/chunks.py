"""Windows over long series, cut into pieces that many tasks can share.

Two cuts are offered.

* By time: bars are unique per (symbol, step), so a span of ``rows`` steps holds at most ``rows`` bars
  of a symbol. The piece size is bounded by the calendar, whatever the skew between symbols.
* By row index (see ``row_index``): for raw rows, where any instant may hold any number of rows.

A frame that spans no more steps than one piece may hold needs no cut at all (``cut_size``).

Each piece receives copies of the rows just outside it (its halo), is evaluated by an ordinary window
partitioned by (keys, piece), and the copies are dropped again. A bounded frame then sees exactly the
rows it would see in one unpartitioned window, in the same order, so results agree bit for bit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)
ROWS_PER_CHUNK = 32_768

CHUNK = "_chunk"
HALO = "_halo"


def time_chunk(at: str, step: timedelta, rows: int | None) -> Column | None:
    """Number of the time span of ``rows`` steps that holds the instant ``at``; None for no cut."""
    if rows is None:
        return None
    span = int(step / timedelta(microseconds=1)) * rows
    return F.floor(F.unix_micros(F.col(at)) / F.lit(span)).cast("long")


def cut_size(
    bars: DataFrame,
    step: timedelta = HOUR,
    rows: int = ROWS_PER_CHUNK,
    at: str = "datetime",
    resolution: timedelta = timedelta(0),
) -> int | None:
    """``rows``, or None if the bars span so few steps that every symbol fits one chunk.

    None means one plain window per key: each group is bounded by the measured span, since bars are
    unique per (symbol, step), and windows in a row share a single shuffle. Looks at one row. ``at`` may
    be a coarser column, such as a partition date, of the given ``resolution``.
    """
    first, last = (F.unix_micros(f(at).cast("timestamp")) for f in (F.min, F.max))
    ends = bars.agg(first.alias("lo"), last.alias("hi")).first()
    micro = timedelta(microseconds=1)
    if ends["lo"] is None or (ends["hi"] - ends["lo"] + resolution // micro) // (step // micro) < rows:
        return None
    return rows


def _halo_rows(
    df: DataFrame, keys: Sequence[str], order: str, payload: Sequence[str], before: int, after: int
) -> DataFrame:
    """For each chunk, the ``before`` and ``after`` nearest rows of the same key outside it.

    Works on chunk edges only, the last rows of chunks and the first ones (``_side`` 1 and -1) in one pass: at most
    ``before`` + ``after`` rows per chunk reach the shuffle (group limit). An edge row goes to the neighbour of
    every chunk whose border is less than that many edge rows away: one chunk as a rule, several when chunks
    are sparse, so gaps of any length are exact.
    """
    side, most = F.col("_side"), max(before, after)
    count = F.when(side == 1, before).otherwise(after)
    sides = F.array(*[F.lit(s) for s, n in ((1, before), (-1, after)) if n])
    last, first = F.when(side == 1, F.col(order)), F.when(side == -1, F.col(order))
    inward = Window.partitionBy(*keys, CHUNK, "_side").orderBy(last.desc(), first.asc())
    edge = (
        df.select(*keys, CHUNK, order, *payload, F.explode(sides).alias("_side"))
        .withColumn("_rank", F.row_number().over(inward))
        .filter(F.col("_rank") <= most)
        .filter(F.col("_rank") <= count)
    )
    outward = Window.partitionBy(*keys, "_side").orderBy(last.asc(), first.desc())
    border = F.when(F.col("_rank") == 1, F.struct("_place", F.lead(CHUNK).over(outward).alias("chunk")))
    near = F.filter("_borders", lambda b: b["chunk"].isNotNull() & (b["_place"] - F.col("_place") < count))
    return (
        edge.withColumn("_place", F.row_number().over(outward))
        .withColumn("_border", border)
        .withColumn("_borders", F.collect_list("_border").over(outward.rowsBetween(0, most - 1)))
        .select(*keys, F.explode(near["chunk"]).alias(CHUNK), order, *payload, F.lit(True).alias(HALO))
    )


def with_halo(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    payload: Sequence[str],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """``df`` (which has a CHUNK column) plus each chunk's halo rows, told apart by HALO."""
    own = df.withColumn(HALO, F.lit(False))
    if not (before or after):
        return own
    return own.unionByName(_halo_rows(df, keys, order, payload, before, after), allowMissingColumns=True)


def over_series(
    df: DataFrame,
    columns: Callable[[WindowSpec], Sequence[dict[str, Column]]],
    payload: Sequence[str],
    before: int = 0,
    after: int = 0,
    keys: Sequence[str] = ("symbol",),
    order: str = "datetime",
    step: timedelta = HOUR,
    rows: int | None = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add windowed columns per key, evaluated chunk by chunk (whole series if ``rows`` is None).

    ``columns`` gets the chunk's window and returns one dict per dependency level. Frames may reach
    ``before`` rows back and ``after`` rows ahead and read only ``payload`` columns.
    """
    if rows is None:
        whole = Window.partitionBy(*keys).orderBy(order)
        return reduce(lambda d, level: d.withColumns(level), columns(whole), df)
    haloed = with_halo(df.withColumn(CHUNK, time_chunk(order, step, rows)), keys, order, payload, before, after)
    window = Window.partitionBy(*keys, CHUNK).orderBy(order)
    added = reduce(lambda d, level: d.withColumns(level), columns(window), haloed)
    return added.filter(~F.col(HALO)).drop(CHUNK, HALO)


def fill_forward(
    df: DataFrame,
    value: Column,
    name: str,
    chunk: Column | None,
    keys: Sequence[str] = (),
    order: str = "datetime",
    default: Column | None = None,
) -> DataFrame:
    """``name`` = last non-null ``value`` so far in the key's series, else ``default``; in two phases.

    First the last known value of each chunk (a small table, one row per chunk), carried along that
    table; then the fill inside each chunk, falling back on the carry. The join and the window share
    one shuffle on (keys, chunk). Without ``chunk`` the key's series is filled as a whole.
    """
    if chunk is None:
        series = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        known = F.last(value, ignorenulls=True).over(series)
        return df.withColumn(name, known if default is None else F.coalesce(known, default))
    marked = df.withColumns({CHUNK: chunk, "_value": value})
    per_chunk = marked.groupBy(*keys, CHUNK).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*keys, CHUNK, F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    so_far = Window.partitionBy(*keys, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sources = [F.last("_value", ignorenulls=True).over(so_far), F.col("_carry")]
    if default is not None:
        sources.append(default)
    filled = marked.join(carry, [*keys, CHUNK]).withColumn(name, F.coalesce(*sources))
    return filled.drop(CHUNK, "_value", "_carry")
