"""Sharding along a Hilbert curve, for files that can be skipped by any of several metadata columns.

Each dimension is quantised to ``BITS`` bits: categories by equal depth (the share of rows before the value, in
the order of values, null last), sizes by the logarithm in eighths of an octave. The cells are walked in the order
of a Hilbert curve, on which neighbours differ in one dimension by one step, and the walk is cut into runs: a shard
covers a compact box of the metadata, so the minima and maxima of its files rule most files out for a
condition on any dimension. Cell by cell, rows are ordered by the text's crc32, doc_id and size, so equal texts with
equal metadata are neighbours.

Positions along the curve come from a range shuffle of narrow rows and running sums of its pieces (one row per piece
in a window); a hot value, source, group of copies or null doc_id is spread, as a serial number tells equal rows apart.

By law ``rows``, shard counts differ by one at most; by law ``bytes``, a shard ends at the row that reaches its equal
share of all sizes, so it is off by the size of two rows at most. Null texts have size 16 (crc32 0) like empty ones; a
null doc_id sorts first. Rows that are equal in all columns read are interchangeable. An empty table gives no rows.
Columns beside doc_id, text, lang and source are not read, unless rows are kept (``with_rows``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.sources.staging import stage

BITS = 8
#: Bytes that a row counts beside its text.
ROW_BYTES = 16
ORDER = ("curve", "text_crc32", "doc_id", "size", "serial")


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def curve_steps(n: int) -> list[int]:
    """The curve in ``n`` dimensions as an automaton: for each state and corner of a cube (bit j for dimension j), at
    state * 2^n + corner, the corner's place on the curve times the number of states plus the state inside it.

    A state is the corner at which the curve enters a cube and the dimension along which it leaves it; inside, the
    corners are visited in Gray code, turned and mirrored accordingly.
    """
    corners, states = 1 << n, n << n
    turn = lambda x, by: ((x << by % n) | (x >> (n - by % n))) & (corners - 1)
    place = {_gray(w): w for w in range(corners)}
    table = []
    for state in range(states):
        entry, along = divmod(state, n)
        for corner in range(corners):
            w = place[turn(corner ^ entry, n - (along + 1) % n)]
            inner = 0 if w == 0 else _gray(2 * ((w - 1) // 2))
            # the dimension that the curve crosses next inside: trailing ones of w, or of w - 1 if w is even
            odd = w if w % 2 else w - 1
            ones = 0 if w == 0 else ((odd ^ (odd + 1)).bit_length() - 1) % n
            table.append(w * states + (entry ^ turn(inner, along + 1)) * n + (along + ones + 1) % n)
    return table


def hilbert_index(dims: Sequence[Column], bits: int = BITS) -> Column:
    """The place on the curve of the cell with these coordinates, each from 0 to 2^bits - 1."""
    n = len(dims)
    corners, states = 1 << n, n << n
    if n * bits + states.bit_length() > 63:
        raise ValueError(f"{n} dimensions of {bits} bits do not fit a long")
    steps = F.array(*[F.lit(s).cast("long") for s in curve_steps(n)])

    def step(walked: Column, level: Column) -> Column:
        corner = F.lit(0).cast("long")
        for j, x in enumerate(dims):
            bit = F.call_function("shiftright", x.cast("long"), level).bitwiseAND(F.lit(1).cast("long"))
            corner = corner + bit * (1 << j)
        here = F.get(steps, (walked % states * corners + corner).cast("int"))
        return (walked - walked % states) * corners + here

    walked = F.reduce(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), F.lit(0).cast("long"), step)
    return F.call_function("div", walked, F.lit(states).cast("long"))


def log_steps(size: Column, per_octave: int = 3) -> Column:
    """Size (at least 2^per_octave) in 2^per_octave equal steps to an octave: exact, as it reads leading bits."""
    octave = F.length(F.bin(size)) - 1 - per_octave
    lead = F.call_function("shiftright", size, octave).bitwiseAND(F.lit((1 << per_octave) - 1).cast("long"))
    return octave.cast("long") * (1 << per_octave) + lead


def running_sums(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """``rows`` with the sum of each column over all rows before, in an order that tells rows apart, and its ``_total``.

    The pieces of a range shuffle are staged once; a window sums inside a piece, another one over the pieces.
    """
    pieces = rows.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    pieces = stage(pieces, label)
    whole = pieces.groupBy("_piece").agg(*[F.sum(c).alias(f"{n}_piece") for n, c in sums.items()])
    every = Window.partitionBy(F.lit(0))
    before = every.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    added = [F.coalesce(F.sum(f"{n}_piece").over(before), F.lit(0)).alias(f"{n}_before") for n in sums]
    added += [F.sum(f"{n}_piece").over(every).alias(f"{n}_total") for n in sums]
    offsets = whole.select("_piece", *added)  # one row per piece of the shuffle
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
    placed = summed.join(F.broadcast(offsets), "_piece").withColumns({n: F.col(n) + F.col(f"{n}_before") for n in sums})
    return placed.drop("_piece", *[f"{n}_before" for n in sums])


def depth_steps(rows: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame:
    """``rows`` with ``name``: the share of rows whose value of ``column`` comes before, in 2^bits steps; null is last."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    order = [F.col(column).asc_nulls_last()]
    placed = running_sums(counts, order, {"_earlier": F.col("_rows")}, "sharding-depths")
    step = F.call_function("div", F.col("_earlier") * (1 << bits), F.col("_earlier_total"))
    steps = stage(placed.select(F.col(column).alias("_value"), step.alias(name)), "sharding-steps")
    return rows.join(steps, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def hilbert_shards(docs: DataFrame, shards: int = 40, law: str = "rows", with_rows: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, curve (cell), shard, slot of every row; ``with_rows``, also ``row``, all its columns.

    The dimensions are lang, source and size. The texts are read once and, unless rows are kept, not moved.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"no such law: {law}")
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    columns = [
        "doc_id", F.col("lang").alias("lang"), F.col("source").alias("source"), (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(body).alias("text_crc32"), F.monotonically_increasing_id().alias("serial"),
    ]
    if with_rows:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = stage(docs.select(*columns), "sharding-rows")
    celled = depth_steps(depth_steps(rows, "lang", "_lang"), "source", "_source")
    celled = celled.withColumn("curve", hilbert_index([F.col("_lang"), F.col("_source"), F.least(log_steps(F.col("size")), F.lit((1 << BITS) - 1))]))
    celled = celled.drop("_lang", "_source", "lang", "source")
    order = [F.col(c) for c in ORDER]
    placed = running_sums(celled, order, {"_rank": F.lit(1).cast("long"), "_bytes": F.col("size")}, "sharding-pieces")
    done, total = (F.col(f"_{'rank' if law == 'rows' else 'bytes'}{end}").cast("decimal(20,0)") for end in ("", "_total"))
    placed = placed.withColumn("shard", F.call_function("div", done * shards, total).cast("int"))  # a product may exceed a long
    if law == "rows":  # a shard begins at the smallest rank whose product reaches it
        first = F.call_function("div", F.col("shard") * F.col("_rank_total") + (shards - 1), F.lit(shards).cast("long"))
    else:
        firsts = stage(placed.groupBy("shard").agg(F.min("_rank").alias("_first")), "sharding-firsts")
        placed = placed.join(F.broadcast(firsts), "shard")  # one row per shard
        first = F.col("_first")
    kept = ["doc_id", "size", "text_crc32", "curve", "shard", (F.col("_rank") - first).alias("slot")]
    return placed.select(*kept, *(["row"] if with_rows else []))


def write_shards(docs: DataFrame, folder: str, shards: int = 40, law: str = "bytes") -> None:
    """Write the rows of ``docs``, all columns as they are, in curve order to ``folder``/shard=N.

    A shard may be larger than a task: each file holds one run of slots.
    """
    placed = hilbert_shards(docs, shards, law, with_rows=True)
    laid = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    # a column of the table may itself be called shard
    names = {c: F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != "shard"}
    laid.select(*names.values(), F.col("shard")).write.partitionBy("shard").parquet(folder)


def manifest(spark: SparkSession, folder: str, dims: Sequence[str] = ("lang", "source", "n_chars")) -> DataFrame:
    """One row per file of ``folder``: its rows and the least and largest value of each dimension."""
    bounds = [f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in dims]
    files = spark.read.parquet(folder).select("shard", *dims, F.col("_metadata.file_path").alias("file"))
    return files.groupBy("file", "shard").agg(F.count(F.lit(1)).alias("rows"), *bounds, *nulls)
