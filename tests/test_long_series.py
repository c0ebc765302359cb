import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barwright.operators.row_index import chunk_rows, fill_rows, over_rows, row_index
from conftest import at, same_rows


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows, a third of them at one instant."""
    rng = random.Random(3)
    rows = [
        (i, at(5.0 if i % 3 == 0 else rng.random() * 48), rng.random() * 100 if i % 5 else None)
        for i in range(3000)
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id long, ts timestamp, value double").repartition(5).cache()


@pytest.fixture(scope="module")
def indexed(hot):
    return row_index(hot, ["ts", "id"], partitions=6)


def test_index_is_the_position_in_the_order(hot, indexed):
    wanted = hot.withColumn("rn", F.row_number().over(Window.orderBy("ts", "id")).cast("long") - 1)
    assert same_rows(indexed.select("id", "rn"), wanted.select("id", "rn"))


def test_hot_instant_is_spread_over_partitions(hot):
    ordered = hot.repartitionByRange(6, "ts", "id")
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1000


@pytest.mark.parametrize("rows", [23, 100, 5000])
def test_chunked_windows_equal_one_window(hot, indexed, rows):
    def levels(w):
        return [
            {
                "lag_6": F.lag("value", 6).over(w),
                "mean": F.avg("value").over(w.rowsBetween(-23, 0)),
                "lead_1": F.lead("value").over(w),
            }
        ]

    got = over_rows(indexed, levels, 23, 1, rows=rows).drop("rn")
    wanted = hot.withColumns(levels(Window.orderBy("ts", "id"))[0])
    assert same_rows(got, wanted)


def test_chunk_smaller_than_halo_is_refused(indexed):
    with pytest.raises(ValueError):
        over_rows(indexed, lambda w: [], 23, 1, rows=22)


@pytest.mark.parametrize("rows", [1, 7, 400])
def test_fill_equals_one_window(hot, indexed, rows):
    rare = F.when(F.col("value") > 97, F.col("value"))  # most chunks hold nothing known
    got = fill_rows(indexed, rare, "filled", rows=rows).drop("rn")
    w = Window.orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert same_rows(got, hot.withColumn("filled", F.last(rare, ignorenulls=True).over(w)))


def test_chunk_rows_are_bounded(indexed):
    assert chunk_rows(indexed) == 1000


def test_windows_never_use_a_single_partition(indexed):
    out = over_rows(indexed, lambda w: [{"m": F.avg("value").over(w.rowsBetween(-5, 0))}], 5, rows=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_window = plan[plan.index("Window"):]
    assert "hashpartitioning(_chunk" in before_window
    # The only single-partition step sums up one row per range partition.
    single = plan[plan.index("SinglePartition"):] if "SinglePartition" in plan else ""
    assert "partial_count" in single or "HashAggregate" in single
