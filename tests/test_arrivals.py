"""Loading by arrival: each file or micro-batch once, however late."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barwright.operators.bars import bar_aggregates, merge_partials, partial_bars, resample
from barwright.plans import ingest
from barwright.plans.ingest import run_arrivals, run_batch
from barwright.plans.layers import Layers
from barwright.schemas import BARS, TICKS
from barwright.streaming.bars import write_ticks
from conftest import at, same_rows
from test_layers import check_layers, make_ticks


def plain_resample(ticks, interval):
    return (
        ticks.groupBy("symbol", F.window("ts", interval)["start"].alias("datetime"))
        .agg(*bar_aggregates(ticks))
        .select("symbol", "datetime", "open", "high", "low", "close", "volume")
    )


@pytest.mark.parametrize("interval", ["1 hour", "1 day", "60000000 microseconds", "30 days"])
def test_long_keys_order_like_time_and_id(spark, interval):
    """Many ticks share an instant; ids are negative, huge, around powers of two, or missing."""
    rng = random.Random(3)
    ids = [0, 1, -1, 2**20, 2**26 - 1, 2**26, 2**31 - 1, 2**31, 2**31 + 1, 2**62, -(2**62), 2**63 - 1, -(2**63), None]
    rows = []
    for _ in range(3000):
        price = None if rng.random() < 0.05 else float(rng.randrange(1000))
        rows.append((rng.choice("ab"), at(rng.choice([-9e5, 0, 0.5, 0.999999, 1, 30, 31.25])), rng.choice(ids), price))
    rows += [("only", at(0), None, 3.0), ("only", at(1), 5, None), ("none", None, 1, 2.0)]
    # of ticks with the same instant and id, any may count: keep one
    ticks = spark.createDataFrame(rows, TICKS).groupBy("symbol", "ts", "tick_id").agg(F.max("price").alias("price")).cache()
    assert same_rows(resample(ticks, interval), plain_resample(ticks, interval))


def test_parts_merge_in_any_order(spark):
    ticks = make_ticks(spark, hours=20).cache()
    parts = [partial_bars(ticks.filter(F.pmod(F.xxhash64("tick_id"), F.lit(4)) == i)) for i in range(4)]
    assert same_rows(merge_partials(parts[2].unionByName(parts[0]).unionByName(parts[3]).unionByName(parts[1])), resample(ticks))


def read(spark):
    return lambda files: spark.read.parquet(*files)


def test_late_files_and_symbols(spark, tmp_path):
    layers = Layers("arrivals")
    ticks = make_ticks(spark, hours=24).cache()
    late = (F.col("symbol") == "b") | F.col("ts").between(at(3), at(5))
    batches = [ticks.filter(~late & (F.col("ts") < at(20))), ticks.filter(~late & (F.col("ts") >= at(20))), ticks.filter(late)]
    opened = []
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        assert run_arrivals(spark, str(tmp_path / "in"), layers, at(30), lambda files: opened.append(files) or read(spark)(files)) == 1
    check_layers(spark, layers, ticks)
    assert [len(o) for o in opened] == [1, 1, 1] and len({o[0] for o in opened}) == 3
    assert run_arrivals(spark, str(tmp_path / "in"), layers, at(30), lambda files: pytest.fail("nothing is new")) == 0


def test_a_load_that_breaks_off_is_repeated_whole(spark, tmp_path, monkeypatch):
    layers, folder = Layers("torn"), str(tmp_path)
    ticks = make_ticks(spark, hours=8).cache()
    ticks.filter(F.col("ts") < at(5.5)).coalesce(1).write.parquet(f"{folder}/a")
    run_arrivals(spark, folder, layers, at(8), read(spark))
    ticks.filter(F.col("ts") >= at(5.5)).coalesce(1).write.parquet(f"{folder}/b")

    def broken(*args):
        raise RuntimeError("broken")

    for step in ("write_bars", "publish"):
        monkeypatch.setattr(ingest, step, broken)
        with pytest.raises(RuntimeError, match="broken"):
            run_arrivals(spark, folder, layers, at(8), read(spark))
        monkeypatch.undo()
    assert run_arrivals(spark, folder, layers, at(8), read(spark)) == 1
    check_layers(spark, layers, ticks)


def test_files_that_change_are_an_error(spark, tmp_path):
    layers = Layers("changing")
    file = tmp_path / "ticks.parquet"
    make_ticks(spark, hours=3).toPandas().to_parquet(file, coerce_timestamps="us")
    run_arrivals(spark, str(tmp_path), layers, at(3), read(spark))
    make_ticks(spark, hours=4).toPandas().to_parquet(file, coerce_timestamps="us")
    with pytest.raises(ValueError, match="changed"):
        run_arrivals(spark, str(tmp_path), layers, at(3), read(spark))


def test_old_bars_are_left_out_and_the_ways_are_not_mixed(spark, tmp_path, make_bars):
    from barwright.plans.layers import store_bars

    layers = Layers("bounded_arrivals")
    ticks = make_ticks(spark, hours=4)
    old = ticks.withColumn("ts", F.col("ts") - F.expr("INTERVAL 800 DAYS"))
    ticks.unionByName(old).coalesce(1).write.parquet(str(tmp_path / "in"))
    run_arrivals(spark, str(tmp_path), layers, at(4), read(spark))
    check_layers(spark, layers, ticks)
    from barwright.sources import tables

    tables.create_schema(spark, "mixed")
    store_bars(make_bars([{"hour": 1, "close": 1.0}]), Layers("mixed"))
    with pytest.raises(ValueError, match="arrival"):
        run_batch(ticks, Layers("mixed"), "x")


def test_a_stream_of_late_ticks_equals_batch(spark, tmp_path):
    layers = Layers("late_stream")
    ticks = make_ticks(spark, hours=12).cache()
    for i in range(3):
        ticks.filter(F.pmod(F.xxhash64("tick_id"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ticks.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    write_ticks(stream, layers, str(tmp_path / "ckpt")).awaitTermination()
    check_layers(spark, layers, ticks)
    assert not run_batch(ticks, layers, "ticks/1")  # a replay
    assert same_rows(spark.table("late_stream.bronze").select(*BARS.fieldNames()), resample(ticks))
