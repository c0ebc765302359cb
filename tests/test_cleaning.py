import random

import pytest
from pyspark.sql import functions as F

from barwright.operators.clean import latest_wins, repair_volume, silver, valid_bars
from barwright.schemas import BARS, conform
from conftest import at, column, series


@pytest.mark.parametrize(
    "given, wanted",
    [
        ([0, 0, 5, 0, 7], [1, 1, 5, 5, 7]),
        ([0, 0, 0], [1, 1, 1]),
        ([3, None, 0, 4], [3, 3, 3, 4]),
    ],
)
@pytest.mark.parametrize("rows", [1, 2, 512])
def test_volume_is_carried_forward(make_bars, given, wanted, rows):
    bars = make_bars(series([10] * len(given), given))
    assert column(repair_volume(bars, rows=rows), "volume") == wanted


def test_row_without_close_is_gone_before_the_fill(make_bars):
    bars = make_bars(series([1, None, 3], [4, 9, 0]))
    out = silver(bars)
    assert column(out, "close") == [1, 3]
    assert column(out, "volume") == [4, 4]


def test_symbols_do_not_mix(make_bars):
    rows = series([1, 2], [5, 0], "a", [0, 2]) + series([1, 2], [0, 0], "b", [1, 3])
    assert column(repair_volume(make_bars(rows)), "volume") == [5, 5, 1, 1]


def test_latest_version_wins_in_any_input_order(spark, make_bars):
    rows = [
        {"hour": 0, "close": 1, "seq": 1}, {"hour": 0, "close": 2, "seq": 2},
        {"hour": 1, "close": 7, "seq": 3}, {"hour": 1, "close": 8, "seq": 3}, {"hour": 1, "close": 6, "seq": 1},
    ]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        out = latest_wins(make_bars(rows, versioned=True).repartition(3))
        assert column(out, "close") == [2, 8]


def test_many_copies_of_one_key_are_combined_before_the_shuffle(spark, make_bars):
    copies = make_bars([{"hour": 0, "close": 1, "seq": 1}], versioned=True).withColumn(
        "ingest_seq", F.explode(F.sequence(F.lit(1), F.lit(5000)))
    )
    out = latest_wins(copies.withColumn("ingest_seq", F.col("ingest_seq").cast("long")))
    assert [r.ingest_seq for r in out.collect()] == [5000]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.index("Exchange") < plan.index("partial_max")


def test_zero_open_gives_null_percentage(make_bars):
    out = silver(make_bars([{"hour": 0, "open": 0, "close": 5}]))
    assert column(out, "price_change_pct") == [None]
    assert column(out, "price_change") == [5.0]


def test_derived_prices_and_calendar(make_bars):
    bars = make_bars(
        [{"datetime": at(24 * 6 + 5), "open": 10, "high": 14, "low": 9, "close": 12.34567}]
    )  # Sunday 2024-01-07 05:00
    row = silver(bars).first()
    assert (row.price_change, row.price_change_pct) == (2.3457, 23.4567)
    assert (row["range"], row.avg_price) == (5.0, 11.3364)
    assert (row.year, row.month, row.day, row.hour, row.day_of_week) == (2024, 1, 7, 5, 1)


def test_valid_bars_projects(make_bars):
    bars = make_bars(series([1, None])).withColumn("extra", F.lit(1))
    assert valid_bars(bars).columns == BARS.fieldNames()


def test_conform_fills_and_rejects(make_bars):
    bars = make_bars(series([1]))
    out = conform(bars.drop("volume"), BARS)
    assert out.columns == BARS.fieldNames() and out.first().volume is None
    with pytest.raises(ValueError):
        conform(bars.drop("symbol"), BARS)
