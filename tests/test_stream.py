from pyspark.sql import functions as F

from barwright.operators.bars import resample
from barwright.operators.clean import silver
from barwright.operators.features import features, with_pending
from barwright.plans.layers import Layers
from barwright.schemas import BARS, GOLD, SILVER, TICKS
from barwright.sources.readers import read_ticks
from barwright.streaming.bars import stream_bars, write_bars, write_layers, written_bars
from conftest import SF, same_rows


def drip(spark, ticks, folder, pieces):
    """The ticks as ``pieces`` files in time order, one micro-batch each."""
    days = F.dayofmonth("ts")
    for i in range(pieces):
        part = ticks.filter((days > 31 * i // pieces) & (days <= 31 * (i + 1) // pieces))
        part.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(folder)


def closed(ticks):
    """Bars that end no later than two hours before the last tick."""
    last = ticks.agg(F.max("ts")).first()[0]
    ends = F.col("datetime") + F.expr("INTERVAL 1 HOUR")
    return resample(ticks).filter(ends <= F.lit(last) - F.expr("INTERVAL 2 HOURS"))


def test_closed_bars_equal_batch(spark, tmp_path):
    ticks = read_ticks(spark, SF)
    stream = drip(spark, ticks, str(tmp_path / "in"), 5)
    write_bars(stream_bars(stream), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = written_bars(spark, str(tmp_path / "out"))
    assert got.columns == BARS.fieldNames()
    assert same_rows(got, closed(ticks))


def test_micro_batches_equal_recompute(spark, tmp_path):
    layers = Layers("streamed")
    ticks = read_ticks(spark, SF)
    stream = drip(spark, ticks, str(tmp_path / "in"), 3)
    write_layers(stream_bars(stream), layers, str(tmp_path / "ckpt")).awaitTermination()
    full = silver(closed(ticks))
    assert same_rows(spark.table("streamed.silver").select(*SILVER.fieldNames()), full)
    assert same_rows(spark.table("streamed.gold").select(*GOLD.fieldNames()), with_pending(features(full)))
