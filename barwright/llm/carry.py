"""Carrying all columns of a table past an operator, whatever their names, and sending small tables to all tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame) -> DataFrame:
    """row (all columns in one), doc_id, text: names that the operator uses can't clash with the table's."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), F.col("doc_id"), F.col("text"))


def unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from ``row``; those in ``changed`` have a new value."""
    return rows.select([changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


#: What is sent to all tasks has at most so many rows, and array elements beside.
SENT_ROWS, SENT_ELEMENTS = 200_000, 2_000_000


def sent(small: DataFrame, array: str | None = None) -> DataFrame:
    """Broadcast if counted to be small, its ``array`` column included; else the join shuffles. For staged tables."""
    if small.limit(SENT_ROWS + 1).count() > SENT_ROWS:
        return small
    if array is not None and (small.agg(F.sum(F.size(array).cast("long"))).first()[0] or 0) > SENT_ELEMENTS:
        return small
    return F.broadcast(small)
