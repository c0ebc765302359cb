"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.sources.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from every node that has a link.

    Each round every root that has a smaller root next to it hooks onto the smallest of them, chains of hooks are
    halved until they are flat, and links inside one root are dropped. All of it are aggregates that
    combine before the shuffle and joins on node, in which Spark splits skewed keys; nothing is gathered
    per component. Null nodes are left out, repeated links count once.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    open_links = stage(pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    roots = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not open_links.isEmpty():
        hooks = stage(open_links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")), "hooks")
        while True:  # node -> up -> up of up, until no up is hooked itself
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = hooks.join(above, "up", "left")
            hooks = stage(jumped.select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "hooks")
            if hooks.filter("moved").isEmpty():
                break
            hooks = hooks.select("node", "up")
        hooks = hooks.select("node", "up")
        roots = stage(_moved(roots, "root", hooks), "roots")
        moved = _moved(_moved(open_links, "a", hooks), "b", hooks).filter("a <> b")
        open_links = stage(moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    return roots


def _moved(rows: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    target = hooks.select(F.col("node").alias(column), "up")
    return rows.join(target, column, "left").withColumn(column, F.coalesce("up", column)).drop("up")
