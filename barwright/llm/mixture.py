"""Mixing sources to target weights by Sainte-Lague apportionment.

Sizes are words. Target shares that exceed ``repeat`` times a source are cut there and the excess is
dealt again by weight. The mix is made of blocks of equal length: the highest quotients
target / (2k - 1) give each source an integer number of blocks, and, by the same rule, each shard of the
source its part of them. A shard is a seeded bucket of a source's documents with about ``shard_words``
words or ``shard_rows`` documents at most (dealt by doc_id and text, so that null and repeated ids spread), laid end to end in the order of doc_id and cut into blocks; a seeded systematic draw picks the blocks, and
the words that a document has in picked blocks are what the mix takes of it. Since the draw is
arithmetic, no row per block or seat is made: the quotients are compared only for the seats that the
smallest and largest possible divisor leave open, at most a few per source or shard.

A null or blank text has size 0 and nothing is taken. A null source is a source of its own, last in order. Rows with
the same doc_id and size are interchangeable; null doc_ids come first. An empty table gives no rows.
Only doc_id, text and source are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.sources.staging import stage

WORD = r"[^\x20\x09-\x0D]+"


def _seeded(seed: int, *parts: Column) -> Column:
    """A non-negative integer below 2^32 from md5, so that other engines agree."""
    key = F.concat_ws("|", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long")


def _name(source: str = "source") -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n"))


def apportion(rows: DataFrame, seats: str, votes: str, most: str, group: list[str], order: list[str]) -> DataFrame:
    """Add ``quota``: the seats of each row by highest quotients votes / (2k - 1), at most ``most``.

    ``seats`` is a column that is equal over a group. A divisor of votes per seat so large that rounding up
    everywhere cannot give away too many seats settles all but a few seats per row; the rest compete.
    """
    over = Window.partitionBy(*group)
    total, n = F.sum(votes).over(over), F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(over)
    at = lambda free: F.when(  # noqa: E731  the seats that need no comparison at this many seats in all
        F.col(votes) > 0, F.floor(F.col(votes) * F.greatest(free, F.lit(0.0)) / F.col("_total") + 0.5)
    ).otherwise(0)
    rows = rows.withColumns({"_total": total, "_n": n})
    rows = rows.withColumn("_sure", at(F.col(seats) - F.col("_n") / 2 - 1)).withColumn("_top", at(F.col(seats) + F.col("_n") / 2 + 1))
    rows = rows.withColumn("_open", F.col(seats) - F.sum("_sure").over(over))
    contest = (
        rows.filter("_top > _sure")
        .select(*group, *[c for c in order if c not in group], "_open", votes, F.explode(F.sequence(F.col("_sure") + 1, F.col("_top"))).alias("_k"))
        .withColumn("_q", F.col(votes) / (2 * F.col("_k") - 1))
    )
    won = (
        contest.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_q"), *order, "_k")))
        .filter("_r <= _open")
        .groupBy(*dict.fromkeys(group + order))
        .agg(F.count("*").alias("_won"))
    )
    return rows.join(won, list(dict.fromkeys(group + order)), "left").withColumn(
        "quota", F.least(F.col("_sure") + F.coalesce("_won", F.lit(0)), F.col(most)).cast("long")
    ).drop("_total", "_n", "_sure", "_top", "_open", "_won")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, repeat: float) -> DataFrame:
    """One row per source: its size and target. The window holds one row per source, summed before."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("source_rows"))
    sources = sources.withColumn("key", _name())
    everything = Window.partitionBy(F.lit(0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(repeat)
    ranked = Window.partitionBy(F.lit(0)).orderBy(cap / F.col("weight"), "key")
    # sources whose cap is lowest for their weight fill up first; the level is the share per weight of the rest
    table = sources.withColumn("weight", weight).withColumn("total", F.sum("source_size").over(everything) * float(share))
    table = table.withColumn("full", F.coalesce(F.sum(cap).over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rest = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    table = table.withColumn("level", (F.col("total") - F.col("full")) / rest)
    level = F.max(F.when(F.col("level") * F.col("weight") <= cap, F.col("level"))).over(everything)
    table = table.withColumn("target", F.least(cap, F.coalesce(level * F.col("weight"), cap)))
    return table.select("source", "key", "source_size", "source_rows", "target")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    repeat: int = 2,
    seed: int = 20,
    block_words: int = 1024,
    shard_words: int = 1 << 18,
    shard_rows: int = 1 << 16,
) -> DataFrame:
    """doc_id, source, size, source_size, target, block_words, taken for every document.

    ``block_words`` is the longest block; it is shorter if the smallest source that has words would
    otherwise have fewer than 256 blocks.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.substring(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")), 1, 16)
    sizes = stage(docs.select("doc_id", "source", size.alias("size"), digest.alias("digest")), "sizes")  # the texts are read once
    targets = source_targets(sizes, weights, share, repeat)
    everything = Window.partitionBy(F.lit(0))
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(everything)
    targets = targets.withColumns(
        {
            "block": F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.coalesce(smallest, F.lit(1)) / 256))).cast("long"),
            "shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("source_rows") / shard_rows)).cast("long"),
        }
    )
    targets = targets.withColumn("seats", F.round(F.sum("target").over(everything) / F.col("block")).cast("long"))
    targets = targets.withColumn("most", F.ceil(F.col("source_size") / F.col("block")) * repeat)
    plan = apportion(targets.withColumn("all", F.lit(0)), "seats", "target", "most", ["all"], ["key"])
    plan = stage(plan.select("key", "source_size", "target", "block", "shards", F.col("quota").alias("source_quota")), "plan")

    everywhere = sizes.withColumn("key", _name()).join(F.broadcast(plan) if _few(plan) else plan, "key")
    blank = everywhere.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))  # has no place in a shard
    shard = F.pmod(_seeded(seed, F.col("doc_id").cast("string"), F.col("digest")), F.col("shards"))
    placed = everywhere.filter("size > 0").withColumn("shard", shard)
    shards = placed.groupBy("key", "shard", "block", "source_quota").agg(F.sum("size").alias("shard_size"))
    shards = shards.withColumn("blocks", F.ceil(F.col("shard_size") / F.col("block"))).withColumn("most", F.col("blocks") * repeat)
    quotas = apportion(shards, "source_quota", "shard_size", "most", ["key"], ["shard"])
    quotas = stage(quotas.select("key", "shard", "blocks", "quota"), "quotas")

    laid = Window.partitionBy("key", "shard").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.join(quotas, ["key", "shard"]).withColumn("stop", F.sum("size").over(laid))
    rows = rows.withColumn("start", F.col("stop") - F.col("size"))
    rows = rows.withColumn("offset", F.pmod(_seeded(seed + 1, "key", F.col("shard").cast("string")), F.greatest("blocks", F.lit(1))))
    # whole rounds, and one more copy of "extra" blocks: block b is picked if (b + offset) * extra / blocks steps over an integer
    rows = rows.withColumn("rounds", F.expr("quota div greatest(blocks, 1)")).withColumn("extra", F.expr("quota % greatest(blocks, 1)"))
    picked = "((({b}) + offset) * extra div greatest(blocks, 1) - offset * extra div greatest(blocks, 1))"
    words = (  # words of picked blocks before a position
        "(" + picked.format(b="{p} div block") + " * block + (" + picked.format(b="{p} div block + 1") + " - "
        + picked.format(b="{p} div block") + ") * ({p} % block))"
    )
    rows = rows.withColumn("taken", F.expr(f"size * rounds + {words.format(p='stop')} - {words.format(p='start')}").cast("long"))
    columns = ["doc_id", "source", "size", "source_size", "target", F.col("block").alias("block_words"), "taken"]
    return rows.select(*columns).unionByName(blank.select(*columns))


def _few(plan: DataFrame, most: int = 100_000) -> bool:
    """One row per source: sent to every task only if they are counted to be few."""
    return plan.limit(most + 1).count() <= most
