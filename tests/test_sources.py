import pytest
from pyspark.sql import functions as F

from barwright.operators.bars import resample
from barwright.schemas import BARS, TICKS
from barwright.sources import tables
from barwright.sources.readers import flat_lower, read_bars, read_ticks, with_size
from conftest import SF, at, column, same_rows, series


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_bars_are_read_under_their_schema(spark, make_bars, tmp_path, fmt):
    bars = make_bars(series([1.5, 2.5], [0, 7]))
    writer = bars.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(str(tmp_path / "bars"))
    got = read_bars(spark, str(tmp_path / "bars"), fmt)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in BARS]
    assert same_rows(got, bars)


def test_headers_are_flattened_and_lower_cased(spark):
    df = spark.createDataFrame([(1, (2.0, 3.0))], "Datetime int, Price struct<Open: double, Close: double>")
    assert flat_lower(df).columns == ["datetime", "open", "close"]
    assert flat_lower(df).first() == (1, 2.0, 3.0)


def test_ticks_of_events(spark):
    ticks = read_ticks(spark, SF)
    assert ticks.columns == TICKS.fieldNames()
    assert ticks.count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_bars_take_first_and_last_tick_with_ties_by_id(spark):
    rows = [
        ("a", at(0.1), 7, 50.0), ("a", at(0.1), 3, 41.0), ("a", at(0.2), -1, 39.0),
        ("a", at(0.9), 8, 45.0), ("a", at(0.9), 9, 44.0), ("a", at(0.95), 10, None), ("a", at(1.0), 11, 1.0),
    ]
    ticks = spark.createDataFrame(rows, TICKS).repartition(4)
    out = resample(with_size(ticks, F.col("price") >= 40))
    first = out.orderBy("datetime").first()
    assert (first.open, first.high, first.low, first.close, first.volume) == (41.0, 50.0, 39.0, 44.0, 4)
    assert column(out, "volume") == [4, 0]


def test_volume_is_the_sum_of_sizes_at_any_price(spark):
    rows = [("a", at(0.1), 1, 0.5), ("a", at(0.2), 2, 0.6), ("a", at(0.3), 3, None), ("b", at(0.1), 4, None)]
    ticks = spark.createDataFrame(rows, TICKS)
    assert column(resample(ticks), "volume") == [2, 0]
    assert column(resample(ticks.withColumn("size", F.col("tick_id") * 10)), "volume") == [30, 0]


def test_ids_of_any_sign_order_ties_only(spark):
    big = 2**62
    rows = [("a", at(0), big, 1.0), ("a", at(0), -big, 2.0), ("a", at(0.00001), -big, 3.0)]
    first = resample(spark.createDataFrame(rows, TICKS)).first()
    assert (first.open, first.close) == (2.0, 3.0)


def test_interval_is_a_parameter(spark):
    rows = [("a", at(h), h, float(h)) for h in range(30)]
    ticks = spark.createDataFrame(rows, TICKS)
    assert column(resample(ticks, "1 day"), "close") == [23.0, 29.0]
    assert resample(ticks, "30 minutes").count() == 30


def test_snapshot_replaces(spark, make_bars):
    tables.create_schema(spark, "snaps", use=True)
    assert spark.catalog.currentDatabase() == "snaps"
    for closes in ([1, 2, 3], [4]):
        tables.snapshot(make_bars(series(closes)), "snaps.s")
    assert column(tables.load(spark, "snaps.s"), "close") == [4]
    spark.catalog.setCurrentDatabase("default")


def test_append_checks_the_schema(spark, make_bars):
    tables.create_schema(spark, "snaps")
    bars = make_bars(series([1])).withColumn("unknown", F.lit(1))
    with pytest.raises(ValueError):
        tables.append(bars, "snaps.a", BARS)
    tables.append(bars.drop("unknown"), "snaps.a", BARS)
    tables.append(bars.drop("volume", "unknown"), "snaps.a", BARS)
    assert tables.load(spark, "snaps.a").columns == BARS.fieldNames()
    with pytest.raises(ValueError):
        tables.append(bars.drop("datetime"), "snaps.a", BARS)
