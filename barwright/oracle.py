"""The same queries in SQL, for comparison by another engine over the same tables."""

from __future__ import annotations

from barwright.operators.split import TRAIN_RATIO
from barwright.plans.model import FEATURES

CUT = "TIMESTAMP '2024-01-20 00:00:00'"
SERIES = "PARTITION BY symbol ORDER BY datetime"
_GOLD_CHECKED = [
    "lag_6", "target_price", "price_change_pct", "rolling_std_12", "return_1h", "volume_change",
]


def _bars(unit: str = "hour") -> str:
    return f"""
      SELECT event_type AS symbol, date_trunc('{unit}', ts)::TIMESTAMP AS datetime,
             arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
             arg_max(value, ts) AS close, count(*) FILTER (value >= 40) AS volume
      FROM events GROUP BY 1, 2"""


_SILVER = f"""
      SELECT * REPLACE (coalesce(last_value(nullif(volume, 0) IGNORE NULLS) OVER
             ({SERIES} ROWS UNBOUNDED PRECEDING), 1) AS volume)
      FROM bars WHERE close IS NOT NULL"""

_PRICES = """round(close - open, 4) AS price_change,
             round((close - open) / nullif(open, 0) * 100, 4) AS price_change_pct,
             round(high - low, 4) AS "range", round((open + high + low + close) / 4, 4) AS avg_price"""

_CALENDAR = """year(datetime) AS "year", month(datetime) AS "month", day(datetime) AS "day",
             hour(datetime) AS "hour", dayofweek(datetime) + 1 AS day_of_week"""

_GOLD = f"""
      SELECT * EXCLUDE (pv), round((close - lag_1) / nullif(lag_1, 0), 6) AS return_1h,
             round(high - low, 6) AS price_range, round((volume - pv) / nullif(pv, 0), 6) AS volume_change
      FROM (SELECT *, {_PRICES}, {_CALENDAR},
                   lag(close, 1) OVER w AS lag_1, lag(close, 3) OVER w AS lag_3, lag(close, 6) OVER w AS lag_6,
                   lag(volume) OVER w AS pv,
                   avg(close) OVER ({SERIES} ROWS 5 PRECEDING) AS sma_6,
                   avg(close) OVER ({SERIES} ROWS 11 PRECEDING) AS sma_12,
                   avg(close) OVER ({SERIES} ROWS 23 PRECEDING) AS sma_24,
                   stddev_samp(close) OVER ({SERIES} ROWS 11 PRECEDING) AS rolling_std_12,
                   lead(close) OVER w AS target_price
            FROM silver WINDOW w AS ({SERIES}))"""

_SPLIT = f"""
      SELECT *, row_number() OVER ({SERIES}) <=
             floor({TRAIN_RATIO}::DOUBLE * count(*) OVER (PARTITION BY symbol)) AS is_train
      FROM gold"""

BARS = f"WITH bars AS ({_bars()})"
DAILY = f"WITH bars AS ({_bars('day')})"
SILVER = f"{BARS}, silver AS ({_SILVER})"


def _with_gold(head: str) -> str:
    checked = " AND ".join(f"{c} IS NOT NULL" for c in _GOLD_CHECKED)
    return f"{head}, allrows AS ({_GOLD}), gold AS (SELECT * FROM allrows WHERE {checked})"


GOLD = _with_gold(SILVER)
SERVED = f"""{GOLD}, served AS (
        SELECT symbol, datetime, close AS actual_close, target_price AS predicted_close FROM gold)"""
SPLIT = f"{GOLD}, parts AS ({_SPLIT})"
REVISED = _with_gold(f"""WITH raw AS ({_bars()}),
      bars AS (
        SELECT * REPLACE (
          CASE WHEN datetime >= {CUT} AND datetime < {CUT} + INTERVAL 3 HOUR THEN close + 1 ELSE close END AS close,
          CASE WHEN datetime >= {CUT} AND datetime < {CUT} + INTERVAL 3 HOUR THEN 0 ELSE volume END AS volume)
        FROM raw),
      silver AS ({_SILVER})""")
MARKS = f"{BARS}, m AS (SELECT symbol, max(datetime) AS max_dt FROM bars WHERE datetime < {CUT} GROUP BY symbol)"


def _past_mark(condition: str) -> str:
    return f"{MARKS} SELECT symbol, datetime, close FROM bars LEFT JOIN m USING (symbol) WHERE max_dt IS NULL OR {condition}"


def _since(span: str) -> str:
    return f"""{BARS} SELECT symbol, datetime, close FROM bars
      WHERE datetime >= (SELECT max(datetime) FROM bars) - INTERVAL {span}"""


def _rsi(head: str) -> str:
    return f"""{head},
      moves AS (SELECT symbol, datetime, close - lag(close) OVER ({SERIES}) AS d FROM bars),
      means AS (
        SELECT symbol, datetime, count(d) OVER f AS n,
               avg(CASE WHEN d > 0 THEN d WHEN d <= 0 THEN 0 END) OVER f AS gain,
               avg(CASE WHEN d < 0 THEN -d WHEN d >= 0 THEN 0 END) OVER f AS loss
        FROM moves WINDOW f AS ({SERIES} ROWS 13 PRECEDING))
      SELECT symbol, datetime, round(CASE WHEN n < 14 THEN NULL WHEN gain = 0 AND loss = 0 THEN 50
             WHEN loss = 0 THEN 100 ELSE 100 - 100 / (1 + gain / nullif(loss, 0)) END, 6) AS rsi_14 FROM means"""


def _scaler_stats() -> str:
    one = "SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM parts WHERE is_train"
    return SPLIT + " " + " UNION ALL ".join(one.format(c=f) for f in FEATURES)


def _scaled() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATURES)
    z = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS z_{c}" for c in FEATURES)
    return f"{SPLIT}, stats AS (SELECT {stats} FROM parts WHERE is_train) SELECT symbol, datetime, {z} FROM gold, stats"


def _best_run() -> str:
    runs = " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS run_order, '{c}' AS predictor, sqrt(avg((target_price - {c}) ** 2)) AS rmse"
        " FROM parts WHERE NOT is_train"
        for i, c in enumerate(["close", "lag_1", "sma_6", "sma_12", "sma_24"])
    )
    return f"""{SPLIT}, runs AS ({runs})
      SELECT run_order, predictor, round(rmse, 6) AS rmse FROM runs ORDER BY runs.rmse, run_order LIMIT 1"""


_SHOWN = """SELECT * REPLACE (round(sma_6, 6) AS sma_6, round(sma_12, 6) AS sma_12, round(sma_24, 6) AS sma_24,
             round(rolling_std_12, 6) AS rolling_std_12) FROM gold"""

ORACLE: dict[str, str] = {
    "ohlcv_bars": f"{BARS} SELECT * FROM bars",
    "file_arrivals": f"{BARS} SELECT * FROM bars",
    "stream_late_bars": f"{BARS} SELECT * FROM bars",
    "daily_bars": f"{DAILY} SELECT * FROM bars",
    "backfill_range": _since("720 DAY"),
    "backfill_range_10d": _since("10 DAY"),
    "overlap_range": _past_mark("datetime >= max_dt - INTERVAL 2 HOUR"),
    "high_water_mark": f"{BARS} SELECT symbol, max(datetime) AS max_dt FROM bars GROUP BY symbol",
    "increment_inclusive": _past_mark("datetime >= max_dt"),
    "increment_exclusive": _past_mark("datetime > max_dt"),
    "latest_row": f"{BARS} SELECT symbol, max(datetime) AS datetime, arg_max(close, datetime) AS close FROM bars GROUP BY symbol",
    "dedup_bars": f"""{BARS}, twice AS (
        SELECT symbol, datetime, close, 1 AS ingest_seq FROM bars UNION ALL
        SELECT symbol, datetime, close + 1, 2 FROM bars WHERE datetime >= {CUT})
      SELECT symbol, datetime, arg_max(close, ingest_seq) AS close FROM twice GROUP BY 1, 2""",
    "clean_bars": f"{BARS} SELECT * FROM bars WHERE close IS NOT NULL",
    "volume_ffill": f"{SILVER} SELECT symbol, datetime, volume FROM silver",
    "silver_features": f"{BARS} SELECT symbol, datetime, {_PRICES} FROM bars WHERE close IS NOT NULL",
    "silver_layer": f"{SILVER} SELECT *, {_PRICES}, {_CALENDAR} FROM silver",
    "calendar_parts": f"{BARS} SELECT symbol, datetime, {_CALENDAR} FROM bars WHERE close IS NOT NULL",
    "carry_union": f"""{SILVER}
      SELECT symbol, max(datetime) AS datetime, arg_max(volume, datetime) AS volume FROM silver
      WHERE datetime < {CUT} GROUP BY symbol UNION ALL
      SELECT symbol, datetime, volume FROM bars WHERE datetime >= {CUT}""",
    "lags": f"""{BARS} SELECT symbol, datetime, lag(close, 1) OVER w AS lag_1, lag(close, 3) OVER w AS lag_3,
      lag(close, 6) OVER w AS lag_6 FROM bars WINDOW w AS ({SERIES})""",
    "returns": f"""{BARS}, p AS (SELECT *, lag(close) OVER ({SERIES}) AS prev FROM bars)
      SELECT symbol, datetime, round((close - prev) / nullif(prev, 0), 6) AS return_1h FROM p""",
    "volume_change": f"""{SILVER}, p AS (SELECT *, lag(volume) OVER ({SERIES}) AS prev FROM silver)
      SELECT symbol, datetime, round((volume - prev) / nullif(prev, 0), 6) AS volume_change FROM p""",
    "target_price": f"{BARS} SELECT symbol, datetime, lead(close) OVER ({SERIES}) AS target_price FROM bars",
    "rolling_means": f"""{BARS} SELECT symbol, datetime,
      round(avg(close) OVER ({SERIES} ROWS 5 PRECEDING), 6) AS sma_6,
      round(avg(close) OVER ({SERIES} ROWS 11 PRECEDING), 6) AS sma_12,
      round(avg(close) OVER ({SERIES} ROWS 23 PRECEDING), 6) AS sma_24 FROM bars""",
    "rolling_std": f"""{BARS} SELECT symbol, datetime,
      round(stddev_samp(close) OVER ({SERIES} ROWS 11 PRECEDING), 6) AS rolling_std_12 FROM bars""",
    "gold_mini": f"""{BARS}, p AS (SELECT symbol, datetime, close, lag(close) OVER w AS lag_1,
        round(avg(close) OVER ({SERIES} ROWS 5 PRECEDING), 6) AS sma_6, lead(close) OVER w AS target_price
        FROM bars WINDOW w AS ({SERIES}))
      SELECT symbol, datetime, lag_1, round((close - lag_1) / nullif(lag_1, 0), 6) AS return_1h, sma_6, target_price FROM p""",
    "gold_features": f"{GOLD} {_SHOWN}",
    "gold_chunked": f"{GOLD} {_SHOWN}",
    "gold_incremental": f"{GOLD} {_SHOWN}",
    "gold_revision": f"{REVISED} {_SHOWN}",
    "global_row_index": "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS rn FROM events",
    "rolling_chunked": """SELECT event_id, lag(value, 6) OVER w AS lag_6,
      round(avg(value) OVER (ORDER BY ts, event_id ROWS 23 PRECEDING), 6) AS sma_24,
      round(stddev_samp(value) OVER (ORDER BY ts, event_id ROWS 11 PRECEDING), 6) AS std_12,
      lead(value) OVER w AS lead_1 FROM events WINDOW w AS (ORDER BY ts, event_id)""",
    "ffill_chunked": """SELECT event_id, last_value(CASE WHEN value >= 40 THEN value END IGNORE NULLS)
      OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""",
    "time_split": f"{SPLIT} SELECT symbol, datetime, is_train FROM parts",
    "time_split_common": f"""{SPLIT}, n AS (SELECT datetime, sum(count(*)) OVER (ORDER BY datetime) AS so_far FROM parts GROUP BY datetime)
      SELECT symbol, datetime, so_far <= floor((SELECT count(*) FROM parts) * 0.8) AS is_train FROM parts JOIN n USING (datetime)""",
    "grid_one_feature": f"""{SPLIT}, t AS (SELECT target_price AS y, close AS x FROM parts WHERE is_train),
      m AS (SELECT avg(x) AS x0, avg(y) AS y0, stddev_pop(x) AS xs, stddev_pop(y) AS ys, covar_pop(x, y) / stddev_pop(x) AS c FROM t),
      g AS (SELECT (row_number() OVER (ORDER BY reg, enet) - 1)::INT AS run_order, * FROM (VALUES (0.01), (0.1), (1.0)) r(reg), (VALUES (0.0), (0.5), (1.0)) e(enet)),
      l AS (SELECT run_order, reg::DOUBLE AS reg, enet::DOUBLE AS enet, x0, y0,
        sign(c) * greatest(abs(c) - reg * enet, 0) / (1 + reg * (1 - enet) / ys) / xs AS w FROM g, m),
      e AS (SELECT l.*, target_price AS y, target_price - (y0 + w * (close - x0)) AS d FROM parts, l WHERE NOT is_train)
      SELECT run_order, reg, enet, round(sqrt(avg(d * d)), 6) AS rmse, round(avg(d * d), 6) AS mse, round(avg(abs(d)), 6) AS mae,
        round(1 - sum(d * d) / (var_pop(y) * count(y)), 6) AS r2 FROM e GROUP BY run_order, reg, enet""",
    "grid_ridge": f"""{SPLIT}, t AS (SELECT target_price AS y, close AS a, "hour"::DOUBLE AS b FROM parts WHERE is_train),
      m AS (SELECT avg(a) AS a0, avg(b) AS b0, avg(y) AS y0, stddev_pop(a) AS sa, stddev_pop(b) AS sb, stddev_pop(y) AS sy, corr(a, b) AS r,
        covar_pop(a, y) / stddev_pop(a) AS ca, covar_pop(b, y) / stddev_pop(b) AS cb FROM t),
      l AS (SELECT run_order, reg::DOUBLE AS reg, *, (ca * (1 + reg / sy) - r * cb) / ((1 + reg / sy) * (1 + reg / sy) - r * r) / sa AS wa,
        (cb * (1 + reg / sy) - r * ca) / ((1 + reg / sy) * (1 + reg / sy) - r * r) / sb AS wb
        FROM (VALUES (0, 0.01::DOUBLE), (1, 0.1::DOUBLE), (2, 1.0::DOUBLE)) g(run_order, reg), m),
      e AS (SELECT run_order, l.reg, target_price AS y, target_price - (y0 + wa * (close - a0) + wb * ("hour" - b0)) AS d FROM parts, l WHERE NOT is_train)
      SELECT run_order, reg, 0.0::DOUBLE AS enet, round(sqrt(avg(d * d)), 6) AS rmse, round(avg(d * d), 6) AS mse, round(avg(abs(d)), 6) AS mae,
        round(1 - sum(d * d) / (var_pop(y) * count(y)), 6) AS r2 FROM e GROUP BY run_order, reg""",
    "scaler_stats": _scaler_stats(),
    "scaled_features": _scaled(),
    "eval_metrics": f"""{SPLIT}, e AS (SELECT target_price AS y, target_price - close AS d FROM parts WHERE NOT is_train)
      SELECT round(sqrt(avg(d * d)), 6) AS rmse, round(avg(d * d), 6) AS mse, round(avg(abs(d)), 6) AS mae,
             round(1 - sum(d * d) / (var_pop(y) * count(y)), 6) AS r2 FROM e""",
    "best_run": _best_run(),
    "serving_shift": f"""{BARS}, p AS (SELECT symbol, datetime, close AS actual_close,
        lead(close) OVER ({SERIES}) AS predicted_close FROM bars)
      SELECT * FROM p WHERE actual_close IS NOT NULL AND predicted_close IS NOT NULL""",
    "recent_10": f"{BARS} SELECT symbol, datetime, close FROM bars ORDER BY datetime DESC, symbol LIMIT 10",
    "recent_5_local": f"""{BARS}, top AS (SELECT * FROM bars ORDER BY datetime DESC, symbol LIMIT 5)
      SELECT symbol, datetime + INTERVAL 330 MINUTE AS datetime_local, close FROM top""",
    "recent_48h": _since("48 HOUR"),
    "dashboard_48h": f"""{SERVED} SELECT *, abs(actual_close - predicted_close) AS error FROM served
      WHERE datetime >= (SELECT max(datetime) FROM served) - INTERVAL 48 HOUR""",
    "dashboard_recent_10": f"{SERVED} SELECT * FROM served ORDER BY datetime DESC, symbol LIMIT 10",
    "dashboard_recent_5_local": f"""{SERVED}, top AS (SELECT * FROM served ORDER BY datetime DESC, symbol LIMIT 5)
      SELECT symbol, datetime + INTERVAL 330 MINUTE AS datetime_local, actual_close, predicted_close FROM top""",
    "prediction_error": f"""{BARS}, p AS (SELECT symbol, datetime, abs(close - lead(close) OVER ({SERIES})) AS error FROM bars)
      SELECT * FROM p WHERE error IS NOT NULL""",
    "actual_vs_predicted": f"""{BARS}, n AS (SELECT symbol, datetime, lead(close) OVER ({SERIES}) AS actual FROM bars)
      SELECT symbol, datetime, close AS predicted, actual FROM bars JOIN n USING (symbol, datetime) WHERE actual IS NOT NULL""",
    "updown_counts": f"""{BARS}, p AS (SELECT symbol,
        round(avg(close) OVER ({SERIES} ROWS 5 PRECEDING) - close, 6) AS move FROM bars)
      SELECT symbol, CASE WHEN move > 0 THEN 'up' WHEN move < 0 THEN 'down' ELSE 'flat' END AS direction,
             count(*) AS n FROM p GROUP BY 1, 2""",
    "rsi_14": _rsi(DAILY),
    "rsi_14_hourly": _rsi(BARS),
    "ma_7": f"{DAILY} SELECT symbol, datetime, round(avg(close) OVER ({SERIES} ROWS 6 PRECEDING), 6) AS ma_7 FROM bars",
    "return_1d": f"""{DAILY}, p AS (SELECT *, lag(close) OVER ({SERIES}) AS prev FROM bars)
      SELECT symbol, datetime, round((close - prev) / nullif(prev, 0) * 100, 6) AS return_1d FROM p""",
    "updown_label": f"""{DAILY}, p AS (SELECT *, lead(close) OVER ({SERIES}) AS nxt FROM bars)
      SELECT symbol, datetime, CASE WHEN nxt IS NULL THEN NULL WHEN nxt > close THEN 1 ELSE 0 END::DOUBLE AS label FROM p""",
    "line_fit": f"""{SPLIT}, t AS (SELECT target_price AS y, close AS x FROM parts WHERE is_train)
      SELECT 'intercept' AS term, round(regr_intercept(y, x), 4) AS value FROM t UNION ALL
      SELECT 'close', round(regr_slope(y, x), 4) FROM t""",
    "line_fit_2": f"""{SPLIT}, t AS (SELECT target_price AS y, close AS a, "hour"::DOUBLE AS b FROM parts WHERE is_train),
      m AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb,
              avg(a) AS a0, avg(b) AS b0, avg(y) AS y0 FROM t),
      s AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS sa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS sb FROM m)
      SELECT 'intercept' AS term, round(y0 - sa * a0 - sb * b0, 4) AS value FROM s UNION ALL
      SELECT 'close', round(sa, 4) FROM s UNION ALL SELECT 'hour', round(sb, 4) FROM s""",
    "stream_bars": f"""{BARS} SELECT * FROM bars
      WHERE datetime + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
}

# The same results from chunked windows, from jobs that run one after the other, and from the tables of the layers.
for _name in ("volume_ffill", "time_split", "serving_shift", "rsi_14_hourly", "gold_incremental", "gold_revision"):
    ORACLE[f"{_name}_chunked"] = ORACLE[_name]
ORACLE["layers_incremental"] = ORACLE["gold_features"]
