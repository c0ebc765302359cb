"""Every operator as a query over the given tables: name -> (spark, directory) -> DataFrame.

Layers that a query reads more than once are staged, as the batch jobs store them; ticks are scanned once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.functions.expr import calendar_columns, price_columns
from barwright.operators import features as ft
from barwright.operators import incremental, marks, momentum, row_index, split
from barwright.operators.bars import resample
from barwright.operators.chunks import DAY, HOUR, cut_size, over_series
from barwright.operators.clean import latest_wins, repair_volume, silver, valid_bars
from barwright.plans import metrics, model, serving
from barwright.plans.ingest import run_arrivals
from barwright.plans.layers import Layers, run_bronze, run_gold, run_layers, run_serving, run_silver
from barwright.schemas import BARS, KEYS
from barwright.session import pin_utc
from barwright.sources.readers import event_ticks, read_ticks, stream_ticks, with_size
from barwright.sources.staging import shared_dir, stage
from barwright.streaming import bars as streaming

CUT = datetime(2024, 1, 20)  # stands for the mark: bars before it count as loaded already
REVISED = timedelta(hours=3)  # bars of this span from CUT are revised in gold_revision
PRICES = ["price_change", "price_change_pct", "range", "avg_price"]
ROUNDED = ["sma_6", "sma_12", "sma_24", "rolling_std_12"]

Query = Callable[[SparkSession, str], DataFrame]


def _traded() -> Column:
    """The given events have no sizes; those below a price of 40 stand for quotes without a trade."""
    return F.col("price") >= 40


def _ticks(spark: SparkSession, path: str) -> DataFrame:
    pin_utc(spark)
    return with_size(read_ticks(spark, path), _traded())


def _hourly(spark: SparkSession, path: str) -> DataFrame:
    return resample(_ticks(spark, path))


def _bars(spark: SparkSession, path: str) -> DataFrame:
    return stage(_hourly(spark, path), "bars")


def _daily(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    bars = stage(resample(_ticks(spark, path), "1 day"), "daily")
    return bars, cut_size(bars, DAY)


def _two_days(bars: DataFrame) -> int:
    """Chunks of 48 hours whatever the span, so that most frames cross a border."""
    return 48


def _settled(df: DataFrame, rows: int | None, label: str) -> DataFrame:
    """Stage a layer that chunked windows read several times; whole-series windows read it once."""
    return df if rows is None else stage(df, label)


def _silver(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    bars = _bars(spark, path)
    rows = cut_size(bars)
    return _settled(silver(bars, rows=rows), rows, "silver"), rows


def _gold(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    bars, rows = _silver(spark, path)
    return ft.gold(bars, rows=rows), rows


def _windowed(bars: DataFrame, columns, payload, before=0, after=0, step=HOUR) -> DataFrame:
    return over_series(bars, columns, payload, before, after, step=step, rows=cut_size(bars, step))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED if c in df.columns})


def _mark() -> Column:
    return marks.instant(CUT)


def _loaded(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("datetime") < _mark())


def _newer(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("datetime") >= _mark())


def _marks(bars: DataFrame) -> DataFrame:
    return stage(marks.high_water_mark(_loaded(bars)), "marks")


def _as_of(bars: DataFrame) -> Column:
    return marks.from_micros(bars.agg(F.unix_micros(F.max("datetime"))).first()[0])


def plain(df: DataFrame) -> DataFrame:
    """Result types that a SQL engine returns for the same query: plain timestamps and bigints."""
    casts = {"timestamp": "timestamp_ntz", "int": "bigint"}
    return df.select(*[F.col(c).cast(casts.get(t, t)).alias(c) for c, t in df.dtypes])


def _next_close(bars: DataFrame) -> DataFrame:
    return serving.next_close(bars, rows=cut_size(bars))


# Bars, ranges and marks


def ohlcv_bars(spark, path):
    return _hourly(spark, path)


def daily_bars(spark, path):
    return resample(_ticks(spark, path), "1 day")


def backfill_range(spark, path):
    bars = _bars(spark, path)
    return marks.backfill_range(bars, _as_of(bars)).select(*KEYS, "close")


def backfill_range_10d(spark, path):
    bars = _bars(spark, path)
    return marks.backfill_range(bars, _as_of(bars), timedelta(days=10)).select(*KEYS, "close")


def overlap_range(spark, path):
    bars = _bars(spark, path)
    return marks.overlap_range(bars, _marks(bars)).select(*KEYS, "close")


def high_water_mark(spark, path):
    return marks.high_water_mark(_hourly(spark, path))


def increment_inclusive(spark, path):
    bars = _bars(spark, path)
    return marks.from_mark(bars, _marks(bars), True).select(*KEYS, "close")


def increment_exclusive(spark, path):
    bars = _bars(spark, path)
    return marks.from_mark(bars, _marks(bars), False).select(*KEYS, "close")


def latest_row(spark, path):
    return marks.latest_row(_hourly(spark, path).select(*KEYS, "close"))


# Cleaning


def dedup_bars(spark, path):
    bars = _bars(spark, path).withColumn("ingest_seq", F.lit(1))
    again = _newer(bars).withColumns({"ingest_seq": F.lit(2), "close": F.col("close") + 1})
    return latest_wins(bars.unionByName(again), unique=True).select(*KEYS, "close")


def clean_bars(spark, path):
    return valid_bars(_hourly(spark, path))


def _volume_ffill(spark, path, size):
    bars = _bars(spark, path)
    return repair_volume(valid_bars(bars), rows=size(bars)).select(*KEYS, "volume")


def volume_ffill(spark, path):
    return _volume_ffill(spark, path, cut_size)


def volume_ffill_chunked(spark, path):
    return _volume_ffill(spark, path, _two_days)


def silver_features(spark, path):
    return valid_bars(_hourly(spark, path)).withColumns(price_columns()).select(*KEYS, *PRICES)


def silver_layer(spark, path):
    return _silver(spark, path)[0]


def calendar_parts(spark, path):
    parts = calendar_columns()
    return valid_bars(_hourly(spark, path)).withColumns(parts).select(*KEYS, *parts)


def carry_union(spark, path):
    bars = _bars(spark, path)
    done = silver(_loaded(bars), rows=cut_size(bars))
    return marks.with_carry(done, _newer(bars)).select(*KEYS, "volume")


# Features


def lags(spark, path):
    out = _windowed(_bars(spark, path), lambda w: [ft.lag_columns(w)], ["close"], before=6)
    return out.select(*KEYS, "lag_1", "lag_3", "lag_6")


def returns(spark, path):
    out = _windowed(
        _bars(spark, path), lambda w: [ft.lag_columns(w), ft.return_column()], ["close"], before=6
    )
    return out.select(*KEYS, "return_1h")


def volume_change(spark, path):
    bars, rows = _silver(spark, path)
    out = over_series(bars, lambda w: [ft.volume_change_column(w)], ["volume"], before=1, rows=rows)
    return out.select(*KEYS, "volume_change")


def target_price(spark, path):
    return _next_close(_bars(spark, path)).select(*KEYS, "target_price")


def rolling_means(spark, path):
    out = _windowed(_bars(spark, path), lambda w: [ft.mean_columns(w)], ["close"], before=23)
    return _rounded(out.select(*KEYS, "sma_6", "sma_12", "sma_24"))


def rolling_std(spark, path):
    out = _windowed(_bars(spark, path), lambda w: [ft.deviation_column(w)], ["close"], before=11)
    return _rounded(out.select(*KEYS, "rolling_std_12"))


def gold_mini(spark, path):
    out = _windowed(
        _bars(spark, path),
        lambda w: [{**ft.lag_columns(w), **ft.mean_columns(w), **ft.target_column(w)}, ft.return_column()],
        ["close"],
        before=ft.LOOK_BACK,
        after=ft.LOOK_AHEAD,
    )
    return _rounded(out.select(*KEYS, "lag_1", "return_1h", "sma_6", "target_price"))


def gold_features(spark, path):
    return _rounded(_gold(spark, path)[0])


def gold_chunked(spark, path):
    """The same features from two-day chunks, most of whose frames cross a border."""
    return _rounded(ft.gold(stage(silver(_bars(spark, path), rows=48), "silver"), rows=48))


def _gold_incremental(spark, path, size):
    """Load up to CUT, then add the rest as an increment of silver and of gold."""
    bars = _bars(spark, path)
    rows = size(bars)
    old = stage(silver(_loaded(bars), rows=rows), "silver-old")
    new = incremental.silver_from(_newer(bars), marks.latest_row(old), rows=rows)
    both = stage(old.unionByName(new), "silver")
    stored = stage(ft.with_pending(ft.features(old, rows=rows)), "gold-old")
    done = stage(incremental.gold_marks(stored), "marks")
    fresh = incremental.gold_from(both, done, rows=rows)
    final = stored.filter(F.col("target_price").isNotNull())  # the increment brings the pending rows anew
    return _rounded(ft.complete_cases(final.unionByName(fresh)))


def gold_incremental(spark, path):
    return _gold_incremental(spark, path, cut_size)


def gold_incremental_chunked(spark, path):
    return _gold_incremental(spark, path, _two_days)


def layers_incremental(spark, path):
    """The batch jobs themselves: three loads into the tables of a database of their own, the layers lagging in between."""
    ticks = _ticks(spark, path)
    layers = Layers(f"layers_{uuid.uuid4().hex}")
    upto = lambda at: ticks.filter(F.col("ts") < marks.instant(at))
    try:
        run_layers(upto(CUT), layers, CUT)
        later = CUT + timedelta(days=3, minutes=20)
        run_bronze(upto(later), layers, later)
        run_gold(spark, layers)  # ahead of silver: waits for it
        run_silver(spark, layers)
        end = CUT + timedelta(days=400)
        run_bronze(ticks, layers, end, since=later - timedelta(hours=2))
        run_gold(spark, layers)
        run_serving(spark, layers)
        run_silver(spark, layers)
        run_gold(spark, layers)
        return _rounded(ft.complete_cases(stage(spark.read.table(layers.name("gold")).drop("date"), "gold")))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {layers.database} CASCADE")


def _arrivals(spark: SparkSession, path: str, pieces: int) -> list[DataFrame]:
    """The events in pieces that do not follow their order, as files that arrive late would hold them."""
    events = spark.read.parquet(f"{path}/events.parquet")
    return [events.filter(F.pmod(F.xxhash64("event_id"), F.lit(pieces)) == i) for i in range(pieces)]


def _stored_bars(spark: SparkSession, layers: Layers) -> DataFrame:
    return stage(spark.read.table(layers.name("bronze")).select(*BARS.fieldNames()), "bars")


def file_arrivals(spark, path):
    """Three folders' worth of files arrive one after the other; each run opens new ones only."""
    pin_utc(spark)
    layers = Layers(f"arrivals_{uuid.uuid4().hex}")
    place = f"{shared_dir(spark)}/{layers.database}"
    read = lambda files: with_size(event_ticks(spark.read.parquet(*files)), _traded())
    try:
        for part in _arrivals(spark, path, 3):
            part.write.mode("append").parquet(place)
            run_arrivals(spark, place, layers, CUT, read, all_layers=False)
        return _stored_bars(spark, layers)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {layers.database} CASCADE")


def stream_late_bars(spark, path):
    """A stream whose ticks come in no order, batch after batch, merged into the stored bars."""
    pin_utc(spark)
    layers = Layers(f"late_{uuid.uuid4().hex}")
    place = f"{shared_dir(spark)}/{layers.database}"
    for part in _arrivals(spark, path, 2):
        part.coalesce(1).write.mode("append").parquet(f"{place}/in")
    events = spark.readStream.schema(spark.read.parquet(f"{place}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/in")
    try:
        streaming.write_ticks(with_size(event_ticks(events), _traded()), layers, f"{place}/checkpoint", all_layers=False).awaitTermination()
        return _stored_bars(spark, layers)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {layers.database} CASCADE")


def _gold_revision(spark, path, size):
    """Load everything, then revise some bars and recompute only what they can reach."""
    bars = _bars(spark, path)
    rows = size(bars)
    old = stage(silver(bars, rows=rows), "silver-old")
    stored = ft.with_pending(ft.features(old, rows=rows))
    revised = (F.col("datetime") >= _mark()) & (F.col("datetime") < _mark() + F.lit(REVISED))
    new_bars = bars.withColumns(
        {
            "close": F.when(revised, F.col("close") + 1).otherwise(F.col("close")),
            "volume": F.when(revised, F.lit(0)).otherwise(F.col("volume")),
        }
    )
    changes = stage(bars.filter(revised).select(*KEYS), "changes")
    reached = stage(incremental.refilled_rows(new_bars, changes, rows=rows), "reached")
    symbols = reached.select("symbol").distinct()
    redone = silver(new_bars.join(symbols, "symbol", "left_semi"), rows=rows).join(reached, KEYS, "left_semi")
    new = stage(old.join(reached, KEYS, "left_anti").unionByName(redone), "silver-new")
    fresh = stage(incremental.gold_touched_by(new, reached, rows=rows), "gold-redone")
    return _rounded(ft.complete_cases(incremental.merge_rows(stored, fresh)))


def gold_revision(spark, path):
    return _gold_revision(spark, path, cut_size)


def gold_revision_chunked(spark, path):
    return _gold_revision(spark, path, _two_days)


# Long series without a key


def _indexed(spark, path):
    events = spark.read.parquet(f"{path}/events.parquet").select("event_id", "ts", "value")
    return row_index.row_index(events, ["ts", "event_id"])


def global_row_index(spark, path):
    return _indexed(spark, path).select("event_id", "rn")


def rolling_chunked(spark, path):
    indexed = _indexed(spark, path)

    def levels(w):
        return [
            {
                "lag_6": F.lag("value", 6).over(w),
                "sma_24": F.round(F.avg("value").over(w.rowsBetween(-23, 0)), 6),
                "std_12": F.round(F.stddev_samp("value").over(w.rowsBetween(-11, 0)), 6),
                "lead_1": F.lead("value", 1).over(w),
            }
        ]

    out = row_index.over_rows(indexed, levels, 23, 1, rows=row_index.chunk_rows(indexed))
    return out.select("event_id", "lag_6", "sma_24", "std_12", "lead_1")


def ffill_chunked(spark, path):
    indexed = _indexed(spark, path)
    known = F.when(F.col("value") >= 40, F.col("value"))
    out = row_index.fill_rows(indexed, known, "filled", rows=row_index.chunk_rows(indexed))
    return out.select("event_id", "filled")


# Training


def _training_gold(spark, path):
    gold, rows = _gold(spark, path)
    return _settled(gold, rows, "gold"), rows


def _train_test(spark, path):
    gold, rows = _training_gold(spark, path)
    return split.train_test(gold, rows=rows)


def time_split(spark, path):
    gold, rows = _training_gold(spark, path)
    return split.time_split(gold, rows=rows).select(*KEYS, "is_train")


def time_split_chunked(spark, path):
    gold = stage(_gold(spark, path)[0], "gold")
    return split.time_split(gold, rows=_two_days(gold)).select(*KEYS, "is_train")


def time_split_common(spark, path):
    """One cut for all symbols."""
    gold = stage(_gold(spark, path)[0], "gold")
    return split.common_split(gold, rows=_two_days(gold)).select(*KEYS, "is_train")


def _line_sums(spark, path, columns):
    """A line without penalty, fitted by the library's trainer: (term, value) rounded to 4 places."""
    train, _ = _train_test(spark, path)
    return model.plain_line(stage(train, "train"), columns).select("term", F.round("value", 4).alias("value"))


def line_fit(spark, path):
    return _line_sums(spark, path, ["close"])


def line_fit_2(spark, path):
    return _line_sums(spark, path, ["close", "hour"])


def scaler_stats(spark, path):
    train, _ = _train_test(spark, path)
    return model.scaler_stats(train).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


def scaled_features(spark, path):
    gold, rows = _gold(spark, path)
    gold = stage(gold, "gold")
    train, _ = split.train_test(gold, rows=rows)
    out = model.scaled(gold, model.fit_scaler(train))
    return out.select(*KEYS, *[F.round(f"z_{c}", 6).alias(f"z_{c}") for c in model.FEATURES])


def eval_metrics(spark, path):
    """Errors of the persistence forecast (next close = close) on the test rows."""
    _, test = _train_test(spark, path)
    out = metrics.evaluate(test, "target_price", "close")
    return out.select(*[F.round(m, 6).alias(m) for m in metrics.METRICS])


def best_run(spark, path):
    """The best of five simple forecasts on the test rows."""
    _, test = _train_test(spark, path)
    runs = [{"predictor": c, "column": c} for c in ("close", "lag_1", "sma_6", "sma_12", "sma_24")]
    best = metrics.best_run(metrics.evaluate_runs(test, "target_price", runs, "column"))
    return best.select("run_order", "predictor", F.round("rmse", 6).alias("rmse"))


def model_grid(spark, path):
    gold, rows = _gold(spark, path)
    return model.fit_grid(*split.train_test(stage(gold, "gold"), rows=rows)).runs


def _rounded_runs(grid: model.Grid) -> DataFrame:
    return grid.runs.select("run_order", "reg", "enet", *[F.round(m, 6).alias(m) for m in metrics.METRICS])


def grid_one_feature(spark, path):
    """All nine points with one feature, where the penalised line has a closed form."""
    train, test = _train_test(spark, path)
    return _rounded_runs(model.fit_grid(stage(train, "train"), test, columns=["close"]))


def grid_ridge(spark, path):
    """Ridge lines of two features."""
    train, test = _train_test(spark, path)
    return _rounded_runs(model.fit_grid(stage(train, "train"), test, elastic_net=[0.0], columns=["close", "hour"]))


def next_step(spark, path):
    bars, rows = _silver(spark, path)
    gold = stage(ft.with_pending(ft.features(bars, rows=rows)), "gold")
    train, test = split.train_test(ft.complete_cases(gold), rows=rows)
    return model.next_step(model.fit_grid(train, test).best(), gold)


def forecast_vs_actual(spark, path):
    """The best fitted model's forecasts of the test rows beside what came true."""
    gold, rows = _gold(spark, path)
    gold = stage(gold, "gold")
    train, test = split.train_test(gold, rows=rows)
    forecasts = model.predict(model.fit_grid(train, test).best(), test)
    both = serving.actual_vs_predicted(forecasts, gold)
    return both.withColumn("error", F.abs(F.col("actual") - F.col("predicted")))


# Serving


def serving_shift(spark, path):
    return serving.serving_shift(_next_close(_bars(spark, path)))


def serving_shift_chunked(spark, path):
    bars = _bars(spark, path)
    return serving.serving_shift(serving.next_close(bars, rows=_two_days(bars)))


def recent_10(spark, path):
    return marks.newest(_hourly(spark, path).select(*KEYS, "close"), 10)


def recent_5_local(spark, path):
    return serving.recent_local(_hourly(spark, path).select(*KEYS, "close"))


def recent_48h(spark, path):
    bars = _bars(spark, path)
    return marks.recent(bars, _as_of(bars)).select(*KEYS, "close").orderBy("datetime", "symbol")


def _served(spark, path):
    """The serving table of the gold layer."""
    return stage(serving.serving_shift(_gold(spark, path)[0]), "serving")


def dashboard_48h(spark, path):
    served = _served(spark, path)
    return serving.dashboard(served, _as_of(served))


def dashboard_recent_10(spark, path):
    return marks.newest(serving.serving_shift(_gold(spark, path)[0]), 10)


def dashboard_recent_5_local(spark, path):
    return serving.recent_local(serving.serving_shift(_gold(spark, path)[0]))


def prediction_error(spark, path):
    served = serving.serving_shift(_next_close(_bars(spark, path)))
    return serving.prediction_error(served).select(*KEYS, "error")


def actual_vs_predicted(spark, path):
    bars = _bars(spark, path)
    persistence = bars.select(*KEYS, F.col("close").alias("prediction"))
    return serving.actual_vs_predicted(persistence, _next_close(bars))


def updown_counts(spark, path):
    out = _windowed(_bars(spark, path), lambda w: [ft.mean_columns(w)], ["close"], before=23)
    return serving.updown_counts(out.select(*KEYS, "close", F.col("sma_6").alias("prediction")))


# Daily indicators


def rsi_14(spark, path):
    bars, rows = _daily(spark, path)
    out = momentum.relative_strength(bars, rows=rows)
    return out.select(*KEYS, F.round("rsi_14", 6).alias("rsi_14"))


def _rsi_hourly(spark, path, size):
    bars = _bars(spark, path)
    out = momentum.relative_strength(bars, step=HOUR, rows=size(bars))
    return out.select(*KEYS, F.round("rsi_14", 6).alias("rsi_14"))


def rsi_14_hourly(spark, path):
    return _rsi_hourly(spark, path, cut_size)


def rsi_14_hourly_chunked(spark, path):
    return _rsi_hourly(spark, path, _two_days)


def ma_7(spark, path):
    bars, rows = _daily(spark, path)
    out = momentum.moving_average(bars, rows=rows)
    return out.select(*KEYS, F.round("ma_7", 6).alias("ma_7"))


def return_1d(spark, path):
    bars, rows = _daily(spark, path)
    out = momentum.percent_return(bars, rows=rows)
    return out.select(*KEYS, F.round("return_1d", 6).alias("return_1d"))


def updown_label(spark, path):
    bars, rows = _daily(spark, path)
    out = momentum.direction_label(bars, rows=rows)
    return out.select(*KEYS, F.col("label").cast("double").alias("label"))


# Streaming


def stream_bars(spark, path):
    pin_utc(spark)
    place = f"{shared_dir(spark)}/stream-{datetime.now():%Y%m%d%H%M%S%f}"
    bars = streaming.stream_bars(with_size(stream_ticks(spark, path), _traded()))
    streaming.write_bars(bars, f"{place}/bars", f"{place}/checkpoint").awaitTermination()
    return streaming.written_bars(spark, f"{place}/bars")


_ALL = [
    ohlcv_bars, daily_bars, backfill_range, backfill_range_10d, overlap_range, high_water_mark,
    increment_inclusive, increment_exclusive, latest_row, dedup_bars, clean_bars, volume_ffill,
    silver_features, silver_layer, calendar_parts, carry_union, lags, returns, volume_change, target_price,
    volume_ffill_chunked, time_split_chunked, serving_shift_chunked, rsi_14_hourly_chunked, gold_incremental_chunked,
    gold_revision_chunked, layers_incremental, line_fit, line_fit_2,
    rolling_means, rolling_std, gold_mini, gold_features, gold_chunked, gold_incremental, gold_revision,
    global_row_index, rolling_chunked, ffill_chunked, time_split, scaler_stats, scaled_features, eval_metrics,
    best_run, model_grid, next_step, forecast_vs_actual, serving_shift, recent_10, recent_5_local, recent_48h,
    dashboard_48h, dashboard_recent_10, dashboard_recent_5_local, prediction_error, actual_vs_predicted,
    updown_counts, rsi_14, rsi_14_hourly, ma_7, return_1d, updown_label, stream_bars,
    file_arrivals, stream_late_bars, time_split_common, grid_one_feature, grid_ridge,
]


def _finished(query: Query) -> Query:
    return lambda spark, path: plain(query(spark, path))


QUERIES: dict[str, Query] = {q.__name__: _finished(q) for q in _ALL}
