from datetime import datetime

from pyspark.sql import functions as F

from barwright.operators.marks import newest
from barwright.plans import serving
from conftest import at, column, series


def test_local_time_of_the_newest_rows(make_bars):
    bars = make_bars([{"datetime": datetime(2024, 1, 7, 5), "close": 1}, {"hour": 0, "close": 2}])
    rows = serving.recent_local(bars.select("symbol", "datetime", "close"), 1).collect()
    assert [(r.datetime_local, r.close) for r in rows] == [(datetime(2024, 1, 7, 10, 30), 1.0)]


def test_serving_pairs_each_close_with_the_next(make_bars):
    bars = serving.next_close(make_bars(series([1, 4, 2])))
    served = serving.serving_shift(bars)
    assert column(served, "actual_close") == [1, 4] and column(served, "predicted_close") == [4, 2]
    assert column(serving.prediction_error(served), "error") == [3, 2]


def test_dashboard_is_the_recent_part_in_order(make_bars):
    served = serving.serving_shift(serving.next_close(make_bars(series(list(range(100))))))
    rows = serving.dashboard(served, at(98)).collect()
    assert [r.datetime for r in rows] == [at(h) for h in range(50, 99)]
    assert {r.error for r in rows} == {1.0}


def test_predictions_meet_what_came_true(make_bars):
    bars = make_bars(series([1, 4, 2]))
    forecasts = bars.select("symbol", "datetime", "close", (F.col("close") * 2).alias("prediction"))
    both = serving.actual_vs_predicted(forecasts, serving.next_close(bars))
    assert column(both, "predicted") == [2, 8] and column(both, "actual") == [4, 2]


def test_directions_are_counted(make_bars):
    bars = make_bars(series([1, 2, 3, 4]))
    forecasts = bars.withColumn("prediction", F.lit(2.0))
    rows = {(r.symbol, r.direction): r.n for r in serving.updown_counts(forecasts).collect()}
    assert rows == {("a", "up"): 1, ("a", "flat"): 1, ("a", "down"): 2}


def test_newest_breaks_ties_by_symbol(make_bars):
    bars = make_bars(series([1, 2], symbol="b") + series([3, 4], symbol="a"))
    assert [(r.symbol, r.close) for r in newest(bars, 3).collect()] == [("a", 4), ("b", 2), ("a", 3)]
