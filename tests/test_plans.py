"""The plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from barwright.operators import marks
from barwright.operators.bars import partial_bars, resample
from barwright.operators.chunks import cut_size
from barwright.operators.clean import silver
from barwright.operators.features import features, gold
from barwright.operators.split import time_split
from barwright.plans.serving import serving_shift
from barwright.schemas import BARS
from barwright.sources.readers import read_ticks
from barwright.sources.staging import shared_dir, stage
from conftest import SF, at, series


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    return stage(silver(resample(read_ticks(spark, SF)), rows=None), "plan-silver")


def test_bars_read_four_columns_and_combine_by_hash_before_the_shuffle(spark):
    text = plan(resample(read_ticks(spark, SF)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text
    # over the ticks, then over the one or two parts of each bar
    assert text.count("HashAggregate") == 4 and "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning") == 2
    raw = plan(partial_bars(read_ticks(spark, SF)))
    assert raw.count("HashAggregate") == 2 and raw.count("Exchange hashpartitioning") == 1 and "decimal" not in raw


def test_time_filters_reach_the_scan(stored):
    text = plan(marks.recent(stored, at(600)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(datetime", text)


def test_columns_are_pruned(stored):
    text = plan(serving_shift(features(stored, rows=None)))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert read == "symbol:string,datetime:timestamp,close:double"


def test_whole_series_layers_share_one_shuffle(stored):
    cleaned = silver(stored.select(*BARS.fieldNames()), rows=None)
    text = plan(time_split(gold(cleaned, rows=None), rows=None))
    assert text.count("Exchange hashpartitioning(symbol") == 1
    assert "SinglePartition" not in text


@pytest.mark.parametrize("rows", [48, 32_768])
def test_chunks_never_meet_in_one_task(stored, rows):
    text = plan(gold(stored, rows=rows))
    assert "SinglePartition" not in text
    assert "hashpartitioning(symbol#" in text and "_chunk#" in text
    # Edges are limited before they are shuffled.
    assert text.count("WindowGroupLimit") == 2  # before and after the one shuffle of the edge table
    assert text.count("Exchange hashpartitioning") <= 3 and text.count("Scan parquet") <= 2


def test_latest_row_is_a_hash_aggregate(stored):
    text = plan(marks.latest_row(stored))
    assert text.count("HashAggregate") == 2 and "Sort" not in text.replace("SortMergeJoin", "")


def test_top_rows_need_no_full_sort(stored):
    assert "TakeOrderedAndProject" in plan(marks.newest(stored, 10))


def test_marks_are_joined_without_a_hint(stored):
    joined = marks.from_mark(stored, marks.high_water_mark(stored), inclusive=False)
    assert "hint" not in joined._jdf.queryExecution().logical().toString().lower()


def test_cut_only_where_a_series_can_be_long(make_bars):
    bars = make_bars(series([1.0] * 10))
    assert cut_size(bars, rows=10) is None
    assert cut_size(bars, rows=9) == 9
    assert cut_size(bars.limit(0)) is None
    dated = bars.withColumn("date", F.to_date("datetime"))
    assert cut_size(dated, rows=24, at="date", resolution=at(24) - at(0)) == 24
    assert cut_size(dated, rows=25, at="date", resolution=at(24) - at(0)) is None


def test_staging_uses_the_shared_folder(spark, stored):
    folder = shared_dir(spark).removeprefix("file:")
    assert stored.inputFiles() and all(folder in f for f in stored.inputFiles())


def test_unique_versions_need_no_sort(spark, make_bars):
    from barwright.operators.clean import latest_wins

    bars = make_bars(series([1.0, 2.0, 3.0]), versioned=True)
    newer = bars.withColumns({"ingest_seq": F.col("ingest_seq") + 1, "close": F.lit(None).cast("double")})
    out = latest_wins(bars.unionByName(newer), unique=True)
    assert plan(out).count("HashAggregate") == 2 and "Sort" not in plan(out)
    assert [r["close"] for r in out.collect()] == [None] * 3
